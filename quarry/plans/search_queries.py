"""Search, predicate and text-analysis queries (P*, T*, L*, J*, S6/S9/S10, Q1s)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.analysis import (file_name_analyzer, path_tokens, text_tokens,
                                       token_rows, url_path)
from quarry.functions.predicates import (any_field, at_least, bool_query, child_matches,
                                         field, match, not_, range_, term, terms)
from quarry.functions.project import (first_line, first_present, format_day, from_epoch_seconds, hit_line,
                                      keys_of, parse_date, pluck, record, subject)
from quarry.operators.aggs import terms_agg
from quarry.functions.analysis import analyze_literal
from quarry.functions.sql import register_sql_functions
from quarry.operators.postings import bm25_postings, docs_with_ids, match_postings, postings, top_page
from quarry.operators.search import Clause, page, ranked_page, search
from quarry.operators.stemming import english_analyzer
from quarry.plans.common import URL_HOST_PATH, URL_PATH_ONLY, load, sql_path_tokens, sql_tokens, text_impacts_path, text_index
from quarry.sources.tables import lookup

SEARCH_WORD = "heti"
TOK = sql_tokens("text")


def match_not_term(spark, d):
    """Flagship: the best documents saying the word that are not from one source, from the stored index."""
    docs = load(spark, d, "documents").select("doc_id", "source", "text")
    best = top_page(spark, text_impacts_path(spark, d), analyze_literal(spark, SEARCH_WORD), digits=6, docs=docs, keep=not_(term("source", "src2")))
    return best.select("doc_id", "source", first_line("text").alias("subject"))


def ranked_not_term(spark, d):
    """The flagship by a scan of the texts, with the statistics of the same run."""
    docs = load(spark, d, "documents", spread_on="doc_id")
    best = ranked_page(docs, [Clause("text", SEARCH_WORD)], "doc_id", must_not=[term("source", "src2")],
                       select=["source", first_line("text").alias("subject")], digits=6)
    return best.select("doc_id", "source", "subject")


def bm25_pruned_top10(spark, d):
    """Two words, one of them frequent: the best ten read from the tops of their posting lists."""
    return top_page(spark, text_impacts_path(spark, d), analyze_literal(spark, "the heti"), digits=6)


def sql_fulltext_page(spark, d):
    """The flagship as one SQL text, with analyzers and match as SQL functions."""
    register_sql_functions(spark)
    load(spark, d, "documents", spread_on="doc_id").createOrReplaceTempView("quarry_documents")
    return spark.sql(f"""
        WITH t AS (SELECT doc_id, source, text, text_tokens(text) AS tokens FROM quarry_documents),
        s AS (SELECT count(tokens) AS n, avg(size(tokens)) AS avgdl, count_if(array_contains(tokens, '{SEARCH_WORD}')) AS df FROM t),
        c AS (SELECT *, (SELECT struct(n, avgdl, df) FROM s) AS corpus FROM t),
        h AS (SELECT doc_id, source, split_part(text, '\\n', 1) AS subject,
                     round(bm25(token_count(tokens, '{SEARCH_WORD}'), size(tokens), corpus), 6) AS score
              FROM c WHERE matches(text, '{SEARCH_WORD}') AND source IS DISTINCT FROM 'src2')
        SELECT doc_id, source, subject FROM h ORDER BY score DESC, doc_id LIMIT 10""")


def sql_token_rows(spark, d):
    """Token rows of a table function, joined laterally and counted, in SQL."""
    register_sql_functions(spark)
    load(spark, d, "part").createOrReplaceTempView("quarry_part")
    return spark.sql("""
        SELECT token, count(*) AS n, min(position) AS first_position
        FROM quarry_part, LATERAL tokens_of(p_name) GROUP BY token""")


def filtered_top10(spark, d):
    """Two words, one of them given twice, within one source that takes no part in scoring."""
    docs = load(spark, d, "documents")
    return ranked_page(docs, [Clause("text", "heti heti worthless")], "doc_id", filter=[term("source", "src1")], digits=6)


def multi_field_top10(spark, d):
    """A required clause on one field and an optional one on another."""
    part = load(spark, d, "part")
    return ranked_page(part, [Clause("p_name", "ring blue"), Clause("p_type", "economy", required=False)], "p_partkey", digits=6)


def stemmed_bool_page(spark, d):
    """First page of the documents with a form of the word, not from one source."""
    docs = load(spark, d, "documents").where(term("lang", "en"))
    hits = docs.where(bool_query(must=[match("text", "ating", english_analyzer)], must_not=[term("source", "src2")]))
    return page(hits.select("doc_id", "source"), 10, id_col="doc_id")


def any_field_nested(spark, d):
    """Any-field search over an array of structs and an array of strings."""
    part = load(spark, d, "part").select("p_partkey", F.array(record(name="p_name"), record(name="p_brand")).alias("items"),
                                         F.array("p_type").alias("tags"))
    return part.where(any_field(part, "ring economy")).select("p_partkey")


def projected_fields(spark, d):
    """Dates from text and from epoch seconds, a member of an array of structs, the keys of a map."""
    orders = load(spark, d, "orders")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    pair = F.array(record(v="o_orderstatus"), record(v="o_orderpriority"))
    return orders.select(
        "o_orderkey", format_day(parse_date(day)).alias("parsed"),
        format_day(from_epoch_seconds(F.unix_seconds(F.col("o_orderdate").cast("timestamp")))).alias("from_epoch"),
        F.array_join(pluck(pair, "v"), ",").alias("plucked"),
        F.array_join(keys_of(F.create_map("o_orderpriority", F.lit(1))), ",").alias("keys"))


def scan_all_matches(spark, d):
    docs = load(spark, d, "documents")
    return docs.where(bool_query(must=[match("text", SEARCH_WORD)],
                                 must_not=[term("source", "src2")]))


def keyword_and_text_forms(spark, d):
    part = load(spark, d, "part")
    hit = bool_query(should=[term(field("p_name.keyword"), "hot ring"), match("p_name", "blue")])
    return part.where(hit).select("p_partkey", "p_name",
                                  F.array_join(text_tokens("p_name"), " ").alias("p_name_tokens"))


def match_any_word(spark, d):
    docs = load(spark, d, "documents")
    return docs.where(match("text", "heti worthless")).select("doc_id", "source")


def terms_any_of(spark, d):
    cust = load(spark, d, "customer")
    return cust.where(terms("c_mktsegment", ["BUILDING", "MACHINERY"])) \
               .select("c_custkey", "c_name", "c_mktsegment")


def range_before(spark, d):
    orders = load(spark, d, "orders")
    return orders.where(bool_query(filter=[range_("o_orderdate", lt="1998-01-01")])) \
                 .select("o_orderkey", "o_orderdate", "o_totalprice")


def min_should_match_2(spark, d):
    docs = load(spark, d, "documents")
    clauses = [match("text", SEARCH_WORD), term("source", "src1"), term("lang", "en")]
    return docs.where(at_least(clauses, 2)).select("doc_id", "source", "lang")


def exclude_keyword(spark, d):
    """Customers in debt have no segment here: rows lacking the field are kept."""
    cust = load(spark, d, "customer").withColumn("c_mktsegment", F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")))
    return cust.where(not_(term(field("c_mktsegment__keyword"), "BUILDING"))) \
               .select("c_custkey", "c_mktsegment")


def any_field_text(spark, d):
    part = load(spark, d, "part")
    return part.where(any_field(part, "ring")).select("p_partkey", "p_name")


def sql_field_limit(spark, d):
    load(spark, d, "nation").createOrReplaceTempView("nation")
    return spark.sql("SELECT n_name, n_nationkey FROM nation WHERE n_regionkey = 1 "
                     "ORDER BY n_nationkey LIMIT 3")


def struct_field_eq(spark, d):
    cust = load(spark, d, "customer").select(
        "c_custkey", record(name="c_name", segment="c_mktsegment").alias("cust"))
    return cust.where(term(field("cust__segment__keyword"), "AUTOMOBILE")) \
               .select("c_custkey", F.col("cust.name").alias("name"))


def nested_exists(spark, d):
    conv = load(spark, d, "conversations")
    return child_matches(conv, "conv_id",
                         lambda t: (t["role"] == "system") & match(t["text"], "the"))


def _path_of(url):
    return url_path(url, keep_host=True)


def path_tokens_q(spark, d):
    pages = load(spark, d, "pages")
    return token_rows(pages, "page_id", path_tokens(_path_of("url")))


def path_token_agg(spark, d):
    pages = load(spark, d, "pages")
    return terms_agg(pages, path_tokens(_path_of("url")), name="token", array=True)


def path_term(spark, d):
    pages = load(spark, d, "pages")
    toks = path_tokens(url_path("url", keep_host=False))
    return pages.where(term(toks, "en", array=True)).select("page_id", "url")


def pattern_capture_tokens(spark, d):
    pages = load(spark, d, "pages")
    return pages.select("page_id", F.explode(file_name_analyzer(_path_of("url"))).alias("token")) \
                .distinct()


def text_tokens_agg(spark, d):
    docs = load(spark, d, "documents", spread_on="doc_id")
    return terms_agg(docs, text_tokens("text"), name="token", array=True)


def postings_q(spark, d):
    docs = load(spark, d, "documents", spread_on="doc_id")
    return postings(docs, "doc_id", "text").select("token", "doc_id", "tf")


def bm25_top10(spark, d):
    docs = load(spark, d, "documents", spread_on="doc_id")
    return search(docs, SEARCH_WORD, "text", "doc_id", k=10, digits=6)


def match_postings_q(spark, d):
    """The flagship's hits read through the stored postings table instead of the text."""
    docs = load(spark, d, "documents")
    post, _ = text_index(spark, d)
    ids = match_postings(post, analyze_literal(spark, SEARCH_WORD))
    return docs_with_ids(docs, ids).where(not_(term("source", "src2")))


def bm25_postings_top10(spark, d):
    """``bm25_top10`` computed from the stored postings and document-length tables."""
    scores = bm25_postings(*text_index(spark, d), analyze_literal(spark, SEARCH_WORD))
    return page(scores.select("doc_id", F.round("_score", 6).alias("_score")), 10,
                order=[F.col("_score").desc()], id_col="doc_id")


def point_lookup(spark, d):
    return lookup(load(spark, d, "customer"), "c_custkey", 1)


def hit_lines(spark, d):
    orders = load(spark, d, "orders")
    done = F.when(term("o_orderstatus", "F"), F.col("o_orderdate") + F.expr("INTERVAL 30 DAY"))
    created = first_present(done, "o_orderdate")
    return orders.select("o_orderkey", hit_line(F.lit("orders"), F.lit("_doc"),
                                                F.col("o_orderkey").cast("string"), created,
                                                "o_orderpriority").alias("line"))


def subject_column(spark, d):
    docs = load(spark, d, "documents")
    return docs.select("doc_id", subject("text").alias("subject"))


QUERIES = {
    "filtered_top10": filtered_top10,
    "multi_field_top10": multi_field_top10,
    "stemmed_bool_page": stemmed_bool_page,
    "any_field_nested": any_field_nested,
    "projected_fields": projected_fields,
    "match_not_term": match_not_term,
    "ranked_not_term": ranked_not_term,
    "bm25_pruned_top10": bm25_pruned_top10,
    "sql_fulltext_page": sql_fulltext_page,
    "sql_token_rows": sql_token_rows,
    "scan_all_matches": scan_all_matches,
    "keyword_and_text_forms": keyword_and_text_forms,
    "match_any_word": match_any_word,
    "terms_any_of": terms_any_of,
    "range_before": range_before,
    "min_should_match_2": min_should_match_2,
    "exclude_keyword": exclude_keyword,
    "any_field_text": any_field_text,
    "sql_field_limit": sql_field_limit,
    "struct_field_eq": struct_field_eq,
    "nested_exists": nested_exists,
    "path_tokens": path_tokens_q,
    "path_token_agg": path_token_agg,
    "path_term": path_term,
    "pattern_capture_tokens": pattern_capture_tokens,
    "text_tokens_agg": text_tokens_agg,
    "postings": postings_q,
    "bm25_top10": bm25_top10,
    "match_postings": match_postings_q,
    "bm25_postings_top10": bm25_postings_top10,
    "point_lookup": point_lookup,
    "hit_lines": hit_lines,
    "subject_column": subject_column,
}

_HP = f"regexp_extract(url, '{URL_HOST_PATH}', 1)"
_PO = f"regexp_extract(url, '{URL_PATH_ONLY}', 1)"
_NOT_SRC2 = "NOT coalesce(source = 'src2', false)"



def _bm25_sql(words: list[str], columns: str, test: str) -> str:
    """BM25 of ``documents.text`` for a list of words, as SQL."""
    df = ", ".join(f"count_if(list_contains(tok, '{w}')) AS df{i}" for i, w in enumerate(words))
    tf = ", ".join(f"len(list_filter(tok, lambda x: x = '{w}')) AS tf{i}" for i, w in enumerate(words))
    score = " + ".join(f"ln(1 + (s.n - s.df{i} + 0.5) / (s.df{i} + 0.5)) * tf{i} / (tf{i} + 1.2 * (0.25 + 0.75 * dl / s.avgdl))"
                       for i in range(len(words)))
    return f"""
        WITH t AS (SELECT *, {TOK} AS tok FROM documents),
        s AS (SELECT count(tok) AS n, avg(len(tok)) AS avgdl, {df} FROM t),
        d AS (SELECT *, {tf}, len(tok) AS dl FROM t)
        SELECT {columns}, round({score}, 6) AS _score FROM d, s
        WHERE list_has_any(tok, {words!r}) AND {test} ORDER BY _score DESC, doc_id LIMIT 10"""


# The English words (stop words aside) whose stem is "at".
_AT_FORMS = "['ats', 'ate', 'ates', 'ated', 'ating', 'atings', 'atful', 'atness']"
_P_NAME, _P_TYPE = sql_tokens("p_name"), sql_tokens("p_type")


def _part_idf(n: str, df: str) -> str:
    return f"ln(1 + ({n} - {df} + 0.5) / ({df} + 0.5))"


ORACLE: dict = {
    "match_not_term": "SELECT doc_id, source, subject FROM (" + _bm25_sql(
        [SEARCH_WORD], "doc_id, source, string_split(text, chr(10))[1] AS subject", _NOT_SRC2) + ")",
    "filtered_top10": _bm25_sql(["heti", "heti", "worthless"], "doc_id", "source = 'src1'"),
    "multi_field_top10": f"""
        WITH t AS (SELECT p_partkey, {_P_NAME} AS a, {_P_TYPE} AS b FROM part),
        s AS (SELECT count(a) AS na, avg(len(a)) AS la, count(b) AS nb, avg(len(b)) AS lb,
                     count_if(list_contains(a, 'ring')) AS d0, count_if(list_contains(a, 'blue')) AS d1,
                     count_if(list_contains(b, 'economy')) AS d2 FROM t),
        f AS (SELECT *, len(list_filter(a, lambda x: x = 'ring')) AS f0, len(list_filter(a, lambda x: x = 'blue')) AS f1,
                     coalesce(len(list_filter(b, lambda x: x = 'economy')), 0) AS f2 FROM t)
        SELECT p_partkey, round({_part_idf('na', 'd0')} * f0 / (f0 + 1.2 * (0.25 + 0.75 * len(a) / la))
             + {_part_idf('na', 'd1')} * f1 / (f1 + 1.2 * (0.25 + 0.75 * len(a) / la))
             + coalesce({_part_idf('nb', 'd2')} * f2 / (f2 + 1.2 * (0.25 + 0.75 * len(b) / lb)), 0), 6) AS _score
        FROM f, s WHERE list_has_any(a, ['ring', 'blue']) ORDER BY _score DESC, p_partkey LIMIT 10""",
    "stemmed_bool_page": f"""
        SELECT doc_id, source FROM documents WHERE lang = 'en' AND list_has_any({TOK}, {_AT_FORMS}) AND {_NOT_SRC2}
        ORDER BY doc_id LIMIT 10""",
    "stemmed_match": f"SELECT doc_id FROM documents WHERE lang = 'en' AND list_has_any({TOK}, {_AT_FORMS})",
    "any_field_nested": f"""
        SELECT p_partkey FROM part
        WHERE list_has_any({sql_tokens("concat_ws(' ', p_name, p_brand, p_type)")}, ['ring', 'economy'])""",
    "projected_fields": """
        SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS parsed, strftime(o_orderdate, '%Y-%m-%d') AS from_epoch,
               concat_ws(',', o_orderstatus, o_orderpriority) AS plucked, o_orderpriority AS keys FROM orders""",
    "scan_all_matches": f"""
        SELECT * FROM documents WHERE list_contains({TOK}, '{SEARCH_WORD}') AND {_NOT_SRC2}""",
    "keyword_and_text_forms": f"""
        SELECT p_partkey, p_name, array_to_string({sql_tokens('p_name')}, ' ') AS p_name_tokens
        FROM part WHERE p_name = 'hot ring' OR list_contains({sql_tokens('p_name')}, 'blue')""",
    "match_any_word": f"""
        SELECT doc_id, source FROM documents WHERE list_has_any({TOK}, ['heti', 'worthless'])""",
    "terms_any_of": """
        SELECT c_custkey, c_name, c_mktsegment FROM customer
        WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')""",
    "range_before": """
        SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
        WHERE o_orderdate < TIMESTAMP '1998-01-01 00:00:00'""",
    "min_should_match_2": f"""
        SELECT doc_id, source, lang FROM documents
        WHERE CAST(coalesce(list_contains({TOK}, '{SEARCH_WORD}'), false) AS INT)
            + CAST(coalesce(source = 'src1', false) AS INT)
            + CAST(coalesce(lang = 'en', false) AS INT) >= 2""",
    "exclude_keyword": """
        SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS c_mktsegment FROM customer
        WHERE c_acctbal < 0 OR c_mktsegment <> 'BUILDING'""",
    "any_field_text": f"""
        SELECT p_partkey, p_name FROM part
        WHERE list_contains({sql_tokens("concat_ws(' ', p_name, p_brand, p_type)")}, 'ring')""",
    "sql_field_limit": """
        SELECT n_name, n_nationkey FROM nation WHERE n_regionkey = 1
        ORDER BY n_nationkey LIMIT 3""",
    "struct_field_eq": """
        SELECT c_custkey, c_name AS name FROM customer WHERE c_mktsegment = 'AUTOMOBILE'""",
    "nested_exists": f"""
        SELECT DISTINCT conv_id FROM conversations
        WHERE role = 'system' AND list_contains({TOK}, 'the')""",
    "path_tokens": f"""
        SELECT page_id, unnest(generate_series(0, len(t) - 1)) AS position, unnest(t) AS token
        FROM (SELECT page_id, {sql_path_tokens(_HP)} AS t FROM pages)""",
    "path_token_agg": f"""
        SELECT token, count(*) AS doc_count FROM
          (SELECT page_id, unnest(list_distinct({sql_path_tokens(_HP)})) AS token FROM pages)
        GROUP BY token ORDER BY doc_count DESC, token LIMIT 10""",
    "path_term": f"""
        SELECT page_id, url FROM pages WHERE list_contains({sql_path_tokens(_PO)}, 'en')""",
    "pattern_capture_tokens": f"""
        SELECT DISTINCT page_id, token FROM (
          SELECT page_id, unnest(list_transform({sql_path_tokens(_HP)},
                 lambda x: [x, regexp_extract(x, '^([^\\.]+)', 1)])) AS pair FROM pages)
        , unnest(pair) AS u(token) WHERE token <> ''""",
    "text_tokens_agg": f"""
        SELECT token, count(*) AS doc_count FROM
          (SELECT doc_id, unnest(list_distinct({TOK})) AS token FROM documents)
        GROUP BY token ORDER BY doc_count DESC, token LIMIT 10""",
    "postings": f"""
        SELECT token, doc_id, count(*) AS tf FROM
          (SELECT doc_id, unnest({TOK}) AS token FROM documents)
        GROUP BY token, doc_id""",
    "bm25_top10": f"""
        WITH t AS (SELECT doc_id, {TOK} AS tok FROM documents),
        s AS (SELECT count(tok) AS n, avg(len(tok)) AS avgdl,
                     count_if(list_contains(tok, '{SEARCH_WORD}')) AS df FROM t),
        d AS (SELECT doc_id, len(list_filter(tok, lambda x: x = '{SEARCH_WORD}')) AS tf,
                     len(tok) AS dl FROM t)
        SELECT doc_id, round(ln(1 + (s.n - s.df + 0.5) / (s.df + 0.5)) * tf
                             / (tf + 1.2 * (0.25 + 0.75 * dl / s.avgdl)), 6) AS _score
        FROM d, s WHERE tf > 0 ORDER BY _score DESC, doc_id LIMIT 10""",
    "point_lookup": "SELECT * FROM customer WHERE c_custkey = 1",
    "match_postings": f"""
        SELECT * FROM documents WHERE list_contains({TOK}, '{SEARCH_WORD}') AND {_NOT_SRC2}""",
    "hit_lines": """
        SELECT o_orderkey, format('/{}/{}/{} ({}): {}', 'orders', '_doc', CAST(o_orderkey AS VARCHAR),
               strftime(coalesce(CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 30 DAY END, o_orderdate), '%Y-%m-%d'),
               string_split(o_orderpriority, chr(10))[1]) AS line FROM orders""",
    "subject_column": """
        SELECT doc_id, left(string_split(text, chr(10))[1], 80) AS subject FROM documents""",
}

ORACLE["bm25_postings_top10"] = ORACLE["bm25_top10"]
ORACLE["ranked_not_term"] = ORACLE["sql_fulltext_page"] = ORACLE["match_not_term"]
ORACLE["bm25_pruned_top10"] = _bm25_sql(["the", "heti"], "doc_id", "true")
ORACLE["sql_token_rows"] = f"""
    SELECT token, count(*) AS n, min(position) AS first_position FROM (
        SELECT unnest(t) AS token, CAST(unnest(generate_series(0, len(t) - 1)) AS INTEGER) AS position FROM (SELECT {_P_NAME} AS t FROM part))
    GROUP BY token"""
