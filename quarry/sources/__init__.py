"""Readers: tables, name patterns, typed delimited files, commit records."""
