"""Best-fit packing of token sequences: best-fit decreasing with a segment tree."""

from __future__ import annotations

import os
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.common import give_back, stored, table

CAPACITY = 2048
END_ID = 0
#: Pieces of one length that one window ranks, about.
CELL_PIECES = 100_000
#: Words whose ids a Python worker remembers before it drops the rare ones (bounds its memory).
CACHED_WORDS = 1_000_000


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


# Words of Latin letters and a run of ASCII punctuation.
_LATIN = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-/:-@\[-`{-~]*)")
# How byte-level models write the two UTF-8 bytes of U+00C0 to U+00FF: 0xC3 as itself, 0xA1 to 0xAC and
# from 0xAE on too, the other bytes as the characters from U+0100 on, after the 33 control bytes and blanks.
_SPELT = {c: chr(0xC3) + chr(b if 0xA1 <= b <= 0xAC or b >= 0xAE else 0x100 + (b - 127 + 33 if b <= 0xA0 else 67))
          for c, b in ((c, c - 0xC0 + 0x80) for c in range(0xC0, 0x100))}


class WordIds:
    """Ids of whole texts, put together from the ids of their blank-separated words.

    Exact for a tokenizer whose pre-tokens never contain white space: a word's ids then do
    not depend on its neighbours. Words seen in several batches stay remembered; of the
    others a worker keeps the latest, so its memory is bounded however many words there are.
    """

    def __init__(self, path: str):
        # tasks already fill the cores: a thread pool in every worker only costs memory and time
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.plain = path == default_tokenizer()
        self.marks: dict[str, list[int]] = {}
        self.most = CACHED_WORDS
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.start = np.zeros(1 << 14, np.int64)
        self.count = np.zeros(1 << 14, np.int64)
        self.seen = np.zeros(1 << 14, np.int32)
        self.used = 0

    def trim(self, words: int) -> None:
        """Forget the words seen in one batch only, and beyond ``words`` the least seen of the
        rest. The counts of those that stay are halved, so that old habits fade."""
        size = len(self.place)
        keep = np.flatnonzero(self.seen[:size] > 1)
        if len(keep) > words:
            keep = np.sort(keep[np.argpartition(self.seen[keep], -words)[-words:]])
        flag = np.zeros(size, bool)
        flag[keep] = True
        kept = [w for w, k in zip(self.place, flag.tolist()) if k]
        start, count, seen, ids = self.start[keep], self.count[keep], self.seen[keep] // 2, self.ids
        self.clear()
        ends = np.cumsum(count)
        self.used = int(count.sum())
        self.ids = np.append(ids[np.repeat(start - ends + count, count) + np.arange(self.used)], np.zeros(1 << 16, np.uint32))
        spare = np.zeros(1 << 14, np.int64)
        self.start, self.count = np.append(ends - count, spare), np.append(count, spare)
        self.seen = np.append(seen, spare.astype(np.int32))
        self.place = dict(zip(kept, range(len(kept))))

    def _encode(self, words: list[str]) -> list[list[int]]:
        """Ids of each word. The default tokenizer's rules change nothing but the case of Latin
        letters (those of ASCII and U+00C0 to U+00FF), spell each in its bytes, and set a run of ASCII
        punctuation after them apart; such words go straight to its model, the others through
        the whole tokenizer."""
        out: list = [None] * len(words)
        rest, ids, marks = [], self.model.tokenize, self.marks
        for i, w in enumerate(words):
            if not self.plain:
                rest.append(i)
            elif w.isascii() and w.isalpha():
                out[i] = [t.id for t in ids(w.lower())]
            elif found := _LATIN.fullmatch(w):
                letters, end = found.groups()
                letters = letters.lower()
                out[i] = [t.id for t in ids(letters if letters.isascii() else letters.translate(_SPELT))]
                if end:
                    if end not in marks:
                        if len(marks) > 4096:
                            marks.clear()
                        marks[end] = [t.id for t in ids(end)]
                    out[i] += marks[end]
            else:
                rest.append(i)
        for i, e in zip(rest, self.tokenizer.encode_batch_fast([words[i] for i in rest], add_special_tokens=False)):
            out[i] = e.ids
        return out

    def _add(self, words: list[str]) -> None:
        for lo in range(0, len(words), 4096):
            part = words[lo: lo + 4096]
            found = self._encode(part)
            n = np.array([len(x) for x in found], np.int64)
            flat = np.array([i for x in found for i in x], np.uint32)
            first = len(self.place)
            while first + len(part) > len(self.start):
                self.start, self.count = np.resize(self.start, 2 * len(self.start)), np.resize(self.count, 2 * len(self.count))
                self.seen = np.resize(self.seen, len(self.start))
            while self.used + len(flat) > len(self.ids):
                self.ids = np.resize(self.ids, 2 * len(self.ids))
            self.start[first: first + len(part)] = self.used + np.cumsum(n) - n
            self.count[first: first + len(part)] = n
            self.seen[first: first + len(part)] = 0
            self.ids[self.used: self.used + len(flat)] = flat
            self.used += len(flat)
            self.place.update(zip(part, range(first, first + len(part))))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in order (uint32), and where each text's ids start (n + 1)."""
        split = pc.ascii_split_whitespace(texts.fill_null(""))
        words = pc.dictionary_encode(split.flatten())
        vocabulary = words.dictionary.to_pylist()
        if len(self.place) > self.most:
            self.trim(self.most // 2)
        get = self.place.get
        at = [get(w, -1) for w in vocabulary]
        new = [w for w, i in zip(vocabulary, at) if i < 0]
        if new:
            self._add(new)
            at = [self.place[w] for w in vocabulary]
        self.seen[at] += 1
        code = np.array(at, np.int64)[words.indices.to_numpy(zero_copy_only=False)] if at else np.zeros(0, np.int64)
        n = self.count[code]
        ends = np.zeros(len(code) + 1, np.int64)
        np.cumsum(n, out=ends[1:])
        flat = self.ids[np.repeat(self.start[code] - ends[:-1], n) + np.arange(ends[-1])]
        return flat, ends[split.offsets.to_numpy() - split.offsets[0].as_py()]


_encoders: dict[str, WordIds] = {}


def _encoder(path: str) -> WordIds:
    if path not in _encoders:
        _encoders[path] = WordIds(path)
    return _encoders[path]


def _slices(texts: pa.Array, limit: int = 1 << 21):
    """(start, length) runs of about ``limit`` bytes; a longer text is a run of its own."""
    n = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    lo, size = 0, 0
    for i, x in enumerate(n):
        if size and size + x > limit:
            yield lo, i - lo
            lo, size = i, 0
        size += x
    if lo < len(n):
        yield lo, len(n) - lo


def token_pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
                 tokenizer: str | None = None, end_id: int = END_ID, forget: bool = False) -> DataFrame:
    """One row per piece: the key, ``piece``, ``start``, ``length``, ``ids_crc32``.

    A document's ids are its tokens, then ``end_id``; longer ones are cut every ``capacity``.
    With ``forget`` a worker remembers no words after a task, and a quarter as many within it: less
    memory where the workers also serve other operators, at the price of encoding words anew.
    """
    path = tokenizer or default_tokenizer()
    kind = docs.schema[key].dataType
    schema = f"`{key}` {kind.simpleString()}, piece int, start long, length long, ids_crc32 long"

    def run(batches):
        encoder = _encoder(path)
        encoder.most = CACHED_WORDS // 4 if forget else CACHED_WORDS
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            for lo, count in _slices(texts):
                flat, at = encoder.encode(texts.slice(lo, count))
                rows, pieces, starts, lengths, sums = [], [], [], [], []
                for i in range(count):
                    ids = np.append(flat[at[i]: at[i + 1]], np.uint32(end_id)).astype("<u4")
                    for p, s in enumerate(range(0, len(ids), capacity)):
                        part = ids[s: s + capacity]
                        rows.append(lo + i)
                        pieces.append(p)
                        starts.append(s)
                        lengths.append(len(part))
                        sums.append(zlib.crc32(part.tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(rows, pa.int64())), pa.array(pieces, pa.int32()), pa.array(starts, pa.int64()),
                     pa.array(lengths, pa.int64()), pa.array(sums, pa.int64())],
                    names=[key, "piece", "start", "length", "ids_crc32"])
                del flat
                pa.default_memory_pool().release_unused()
        if forget:
            encoder.clear()
            give_back()

    return docs.select(key, text).mapInArrow(run, schema)


class OpenSequences:
    """Open sequences by remaining capacity, with a segment tree to find the tightest fit.

    Sequences with the same room are interchangeable, so a leaf holds runs of sequence
    numbers (first, how many); an inner node tells whether any leaf below is in use.
    """

    def __init__(self, capacity: int):
        self.leaves = 1 << max(1, (capacity + 1 - 1).bit_length())
        while self.leaves < capacity + 1:
            self.leaves *= 2
        self.used = bytearray(2 * self.leaves)
        self.runs: dict[int, list[tuple[int, int]]] = {}

    def _mark(self, room: int, value: int) -> None:
        node = self.leaves + room
        self.used[node] = value
        node //= 2
        while node:
            self.used[node] = self.used[2 * node] | self.used[2 * node + 1]
            node //= 2

    def push(self, room: int, first: int, count: int) -> None:
        if count and room:
            if not self.runs.get(room):
                self._mark(room, 1)
            self.runs.setdefault(room, []).append((first, count))

    def pop(self, room: int) -> tuple[int, int]:
        run = self.runs[room].pop()
        if not self.runs[room]:
            self._mark(room, 0)
        return run

    def tightest(self, need: int) -> int | None:
        """The smallest remaining capacity in use that is at least ``need``, in O(log capacity)."""
        node = self.leaves + need
        if node >= 2 * self.leaves:
            return None
        if self.used[node]:
            return need
        while node > 1:
            if node % 2 == 0 and self.used[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.used[2 * node] else 2 * node + 1
                return node - self.leaves
            node //= 2
        return None


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int]]:
    """Best-fit decreasing over ``counts`` (length -> how many pieces).

    Returns (length, first rank, first sequence, offset): the pieces of that length ranked
    from ``first rank`` up to the next entry's go to consecutive sequences from ``first
    sequence``, each at ``offset``. Pieces of one length are interchangeable, and the
    tightest fit of a piece is again the tightest for the next one while it still fits, so
    a run of equal sequences takes its pieces together; the packing is the same as piece by
    piece. Work and memory depend on the distinct lengths and rooms, not on the pieces.
    """
    out: list[tuple[int, int, int, int]] = []
    open_ = OpenSequences(capacity)
    made = 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0

        def fill(room: int, first: int, count: int, each: int) -> None:
            nonlocal rank, left
            for layer in range(each if count else 0):
                out.append((length, rank, first, capacity - room + layer * length))
                rank += count
            left -= count * each
            open_.push(room - each * length, first, count)

        while left:
            room = open_.tightest(length)
            if room is None:
                room, first = capacity, made
                count = -(-left // (capacity // length))
                made += count
            else:
                first, count = open_.pop(room)
            each = room // length
            full = min(count, left // each)
            fill(room, first, full, each)
            if full < count and left:
                fill(room, first + full, 1, left)
                full += 1
            open_.push(room, first + full, count - full)
    return out


def assign_sequences(spark: SparkSession, pieces: DataFrame, key: str = "doc_id", capacity: int = CAPACITY,
                     cells: int | None = None) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``.

    Only the counts by length (at most ``capacity`` rows) reach the driver. A piece's rank
    within its length is its rank in one of ``cells`` hash cells plus the cell's start, so a
    length that many pieces share is no single window: one cell per ``CELL_PIECES`` pieces of
    the whole table, 256 at least, whatever their lengths. ``pieces`` is a stored table.
    """
    cells = cells or max(256, pieces.count() // CELL_PIECES)
    spread = pieces.withColumn("__cell", F.pmod(F.xxhash64(key, "piece", "ids_crc32"), F.lit(cells)).cast("int"))
    sums = spread.groupBy("length", "__cell").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in sums.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = best_fit_decreasing(counts, capacity)
    span = 1 << 48
    plan.sort()
    table_ = np.array(plan or [(0, 0, 0, 0)], np.int64)
    shared = spark.sparkContext.broadcast((table_[:, 0] * span + table_[:, 1], table_))
    ahead = Window.partitionBy("length").orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("length", "__cell", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("__cell_at"))
    inside = Window.partitionBy("length", "__cell").orderBy(key, "piece", "ids_crc32")
    ranked = (spread.withColumn("__in_cell", F.row_number().over(inside) - 1)
              .join(starts, ["length", "__cell"])
              .withColumn("__rank", (F.col("__cell_at") + F.col("__in_cell")).cast("long")))

    @F.pandas_udf("struct<sequence_id: long, offset: long>")
    def place(length, rank):
        import pandas as pd
        keys, rows = shared.value
        at = np.searchsorted(keys, length.to_numpy() * span + rank.to_numpy(), "right") - 1
        hit = rows[at]
        return pd.DataFrame({"sequence_id": hit[:, 2] + rank.to_numpy() - hit[:, 1], "offset": hit[:, 3]})

    return ranked.withColumn("__p", place("length", "__rank")).select(
        *pieces.columns, F.col("__p.sequence_id"), F.col("__p.offset"))


def best_fit_pack(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text",
                  capacity: int = CAPACITY, tokenizer: str | None = None, forget: bool = False) -> DataFrame:
    """Pack the pieces of all documents into as few sequences as best-fit decreasing needs.

    Returns one row per piece (see the contract of ``op10``); sequence numbers start at 0.
    Pieces are written once (numbers only, no ids) so that no text is tokenized twice.

    Defined cases: a null or empty text is one piece holding only the end id; null and
    repeated keys are packed like any other; an empty table gives no rows; columns other
    than ``key`` and ``text`` are not carried.
    """
    pieces = stored(spark, token_pieces(docs, key, text, capacity, tokenizer, forget=forget), "token-pieces", 1024 if forget else None)
    return assign_sequences(spark, pieces, key, capacity)


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_pack(spark, table(spark, sf_dir, "documents"))


def packed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents as packed pieces."""
    return best_fit_pack(spark, docs, forget=True)
