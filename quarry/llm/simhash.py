"""SimHash near-dedup: fingerprints of word shingles, a byte-position inverted index with count filtering."""

from __future__ import annotations

from itertools import combinations, islice, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import stored, table
from quarry.llm.ngram_join import connected_components

WORDS = 3
HASH_SEED = 42
#: Fingerprints link at this many differing bits or fewer.
MOST_BITS = 3
#: So many of the 8 positional bytes are equal in linked fingerprints at least.
LEAST_BYTES = 8 - MOST_BITS
#: Lists of more fingerprints than this are divided by two further positions.
LONG_LIST = 1024
_CHUNK_BYTES = 1 << 20
_CHUNK_SHINGLES = 1 << 16
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

# Any 5 of the 8 positions hold 3 of the first four or 3 of the last four, so each linked
# pair meets in at least one of the lists of these 8 triples of positions.
TRIPLES = [t for half in ((0, 1, 2, 3), (4, 5, 6, 7)) for t in combinations(half, 3)]
FIVES = list(combinations(range(8), LEAST_BYTES))


def _words(raw: bytes):
    """The lower-cased words of a text, chunk by chunk; a word cut by a chunk's end waits for the rest."""
    rest = b""
    for lo in range(0, len(raw), _CHUNK_BYTES):
        piece = rest + raw[lo: lo + _CHUNK_BYTES].translate(_LOWER)
        words = piece.split()
        rest = b""
        if lo + _CHUNK_BYTES < len(raw) and words and not piece[-1:].isspace():
            rest = words.pop()
        yield from words
    if rest:
        yield rest


def shingle_hashes(raw: bytes):
    """XXH64 of every shingle of ``WORDS`` words, repeats included, in chunks (uint64)."""
    words = list(_words(raw)) if len(raw) <= _CHUNK_BYTES else _words(raw)
    if isinstance(words, list):
        shingles = map(b" ".join, zip(words, words[1:], words[2:])) if len(words) >= WORDS else iter([b" ".join(words)] if words else [])
    else:
        head = list(islice(words, WORDS - 1))

        def slide():
            window = list(head)
            short = True
            for w in words:
                yield b" ".join((*window, w))
                window, short = [*window[1:], w], False
            if short and window:
                yield b" ".join(window)
        shingles = slide()
    while True:
        some = list(islice(shingles, _CHUNK_SHINGLES))
        if not some:
            return
        yield np.fromiter(map(xxhash.xxh64_intdigest, some, repeat(HASH_SEED)), np.uint64, len(some))


def fingerprint(raw: bytes | None) -> int:
    """The 64-bit SimHash of a text; 0 for a null text or one without words."""
    ones, n = np.zeros(64, np.int64), 0
    for h in shingle_hashes(raw or b""):
        ones += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(h)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _fingerprints(batches):
    for batch in batches:
        marks = np.array([fingerprint(t) for t in batch.column("text").to_pylist()], np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(marks.view(np.int64))], names=["id", "mark"])


def with_fingerprints(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(id, mark) of every row: its key and its fingerprint as a signed long."""
    rows = docs.select(F.col(key).alias("id"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(_fingerprints, f"id {docs.schema[key].dataType.simpleString()}, mark long")


def _merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels (each the least index of its group) after joining the groups of ``i`` and ``j``."""
    while True:
        a, b = label[i], label[j]
        open_ = a != b
        if not open_.any():
            return label
        i, j, a, b = i[open_], j[open_], a[open_], b[open_]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up


def linked_pairs(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether fingerprints are linked: the tally of equal positional bytes first, then the bits."""
    differ = x ^ y
    tally = (differ[..., None].view(np.uint8) == 0).sum(axis=-1)
    out = tally >= LEAST_BYTES
    out[out] = np.bitwise_count(differ[out]) <= MOST_BITS
    return out


def _groups_by_tally(marks: np.ndarray) -> np.ndarray:
    """Labels of one list's groups, every pair tallied, in blocks."""
    label = np.arange(len(marks))
    for lo in range(0, len(marks), 256):
        i, j = np.nonzero(linked_pairs(marks[lo: lo + 256, None], marks[None, lo:]))
        label = _merge(label, i + lo, j + lo)
    return label


def _groups_by_probe(marks: np.ndarray, free: tuple) -> np.ndarray:
    """Labels of the groups of distinct fingerprints that are equal outside the ``free`` byte positions.

    What is left is 24 bits, so each fingerprint has 2,324 places that a linked one can be
    at. They are looked up in a table of all places: work in proportion to the list.
    """
    place = np.zeros(len(marks), np.int64)
    for k, position in enumerate(free):
        place |= ((marks >> np.uint64(8 * position)) & np.uint64(255)).astype(np.int64) << (8 * k)
    at = np.full(1 << 24, -1, np.int32)
    at[place] = np.arange(len(marks))
    label = np.arange(len(marks))
    for bits in range(1, MOST_BITS + 1):
        for flips in combinations(range(24), bits):
            other = at[place ^ sum(1 << f for f in flips)]
            i = np.flatnonzero(other >= 0)
            if len(i):
                label = _merge(label, i, other[i].astype(np.int64))
    return label


def _joined(pdf_batches):
    """Links enough to connect each list's groups: rows sorted by (positions, value) are the inverted lists.

    Lists of few fingerprints are compared for a whole batch at once, others one by one. A
    list divided by five positions holds at most 2**24 fingerprints (16 bytes each), any
    other ``LONG_LIST``.
    """
    held = None

    def work(which, value, marks):
        new = np.ones(len(marks), bool)
        new[1:] = (which[1:] != which[:-1]) | (value[1:] != value[:-1])
        starts, run = np.flatnonzero(new), np.cumsum(new) - 1
        size = np.diff(np.append(starts, len(marks)))
        out = []
        for d in range(1, 16):  # lists of up to 16
            i = np.flatnonzero((run[d:] == run[:-d]) & (size[run[d:]] <= 16)) if d < len(marks) else ()
            if not len(i):
                break
            ok = linked_pairs(marks[i], marks[i + d]) & (marks[i] != marks[i + d])
            out.append((marks[i[ok]], marks[i[ok] + d]))
        for k in np.flatnonzero(size > 16):
            some = np.unique(marks[starts[k]: starts[k] + size[k]])
            if len(some) > LONG_LIST:
                label = _groups_by_probe(some, tuple(p for p in range(8) if p not in FIVES[which[starts[k]] - len(TRIPLES)]))
            else:
                label = _groups_by_tally(some)
            i = np.flatnonzero(label != np.arange(len(some)))
            out.append((some[label[i]], some[i]))
        a, b = (np.concatenate([np.zeros(0, np.uint64), *x]) for x in zip(*out)) if out else (np.zeros(0, np.uint64),) * 2
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)}).drop_duplicates()

    for pdf in pdf_batches:
        if not len(pdf):
            continue
        rows = [pdf["which"].to_numpy(), pdf["value"].to_numpy(), pdf["mark"].to_numpy().view(np.uint64)]
        if held is not None:
            rows = [np.concatenate(x) for x in zip(held, rows)]
        which, value, _ = rows
        last = int(np.flatnonzero((which != which[-1]) | (value != value[-1]))[-1]) + 1 if (which[0] != which[-1] or value[0] != value[-1]) else 0
        held = [x[last:] for x in rows]
        if last:
            yield work(*(x[:last] for x in rows))
    if held is not None:
        yield work(*held)


def _value(positions, mark: str = "mark"):
    """The bytes of a fingerprint at these positions as one long."""
    out = F.lit(0).cast("long")
    for k, p in enumerate(positions):
        out = out.bitwiseOR(F.shiftleft(F.shiftrightunsigned(mark, 8 * p).bitwiseAND(F.lit(255)), 8 * k))
    return out


def simhash_links(spark: SparkSession, marks: DataFrame) -> DataFrame:
    """Links (a, b) between the distinct ``mark`` values that connect all fingerprints within ``MOST_BITS``.

    Inverted index: linked fingerprints agree in ``LEAST_BYTES`` of 8 positional bytes. A list
    of one position's byte would hold every 256th fingerprint of the corpus, so the lists that
    are read are the intersections of three positions' lists, for 8 triples that miss no
    pair. Inside a list the equal positional bytes of a pair are tallied, pairs of at least
    ``LEAST_BYTES`` are kept and their bits compared.

    Lists of more than ``LONG_LIST`` fingerprints, found by a count with map-side combine,
    are divided by each two of the other five positions: the pair tally demands two more.
    Such a list leaves 24 bits open, so it cannot outgrow a task, and long ones are searched by probing.
    """
    lists = marks.select("mark", F.explode(F.array(*[F.struct(F.lit(t).alias("which"), _value(p).alias("value"))
                                                     for t, p in enumerate(TRIPLES)])).alias("l")).select("mark", "l.which", "l.value")
    long_ = lists.groupBy("which", "value").agg(F.count("*").alias("size")).where(F.col("size") > LONG_LIST).drop("size")
    long_ = stored(spark, long_, "long-lists").withColumn("long", F.lit(True))
    known = lists.join(long_, ["which", "value"], "left")
    divided = F.array(*[F.struct(F.lit(len(TRIPLES) + f).alias("which"), _value(p).alias("value"), F.array(
        *[F.lit(t) for t, triple in enumerate(TRIPLES) if set(triple) <= set(p)]).alias("of")) for f, p in enumerate(FIVES)])
    five = (known.where("long").select("mark", F.col("which").alias("triple"), F.explode(divided).alias("l"))
            .where(F.array_contains("l.of", F.col("triple"))).select("l.which", "l.value", "mark").distinct())
    rows = known.where("long is null").select("which", "value", "mark").union(five)
    return (rows.repartition("which", "value").sortWithinPartitions("which", "value")
            .mapInPandas(_joined, "a long, b long"))


def simhash_groups(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``fingerprint`` (16 hex digits) and ``component_id`` (least key reachable) of every row.

    Equal fingerprints meet once, in a group-by; only distinct ones are indexed, and all
    that are linked end in one component, whatever the size of a list or group.

    Defined cases: a null text and one without words have fingerprint zero, linked like any
    other; fewer words than ``WORDS`` are one shingle; null keys take part and get their
    component's least key (null if it has none); repeated rows stay rows of their own; an
    empty table gives no rows; other columns, whatever their names, are not used.
    """
    rows = stored(spark, with_fingerprints(docs, key, text), "fingerprints")
    classes = stored(spark, rows.groupBy("mark").agg(F.min("id").alias("least")), "fingerprint-classes")
    components = connected_components(spark, simhash_links(spark, classes.select("mark")))
    placed = (classes.join(components.withColumnRenamed("node", "mark"), "mark", "left")
              .withColumn("component", F.coalesce("component", "mark")))
    least = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    by_mark = placed.join(least, "component").select("mark", "component_id")
    return rows.join(by_mark, "mark").select(
        F.col("id").alias(key), F.lower(F.lpad(F.hex("mark"), 16, "0")).alias("fingerprint"), "component_id")


def op13_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(spark, table(spark, sf_dir, "documents"))
