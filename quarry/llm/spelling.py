"""Spelling variant grouping: k-d trees over letter-count vectors, box-pruned range searches, letter order verified."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.common import stored, table

#: Words have at least so many code points and occurrences.
LEAST_LETTERS = 5
LEAST_COUNT = 3
#: One letter is left out of a run when its checksum is a multiple of this.
SLIP_EVERY = 97
#: A word's form has at least so many times the word's occurrences.
FORM_RATIO = 2
#: Letters: a to z, and U+00C0 to U+00FF as they are.
LETTERS = 26 + 64
#: A length with more words than this is divided by a tree of cells of about as many words,
#: over a sample; at most so many cells a length, and lengths up to ``TREE_LENGTHS`` only.
CELL_WORDS = 4096
MOST_CELLS = 1024
SAMPLE_PER_CELL = 8
TREE_LENGTHS = 64
#: Words, or queries, of a cell that one task takes at a time; a larger cell is searched block by block.
BLOCK = 16_384
LEAF_VECTORS = 24
HELD_WORDS = 300_000

# In text whose A-Z are lower case already; shorter runs can make no word.
_RUN = re.compile("[a-zÀ-ÿ]{%d,}" % LEAST_LETTERS)
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_COUNTS = pa.schema([("word", pa.string()), ("n", pa.int64())])


def add_words(held: dict, key: str, text: str, least: int = LEAST_LETTERS) -> None:
    """Count the words of one document: runs of letters, some with a letter left out."""
    if not text.islower():
        text = text.encode().translate(_LOWER).decode()
    start, get = zlib.crc32(f"{key}:".encode()), held.get
    for run, n in Counter(_RUN.findall(text)).items():
        h = zlib.crc32(run.encode(), start)
        if h % SLIP_EVERY == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
            if len(run) < least:
                continue
        held[run] = get(run, 0) + n


def _count_words(batches):
    """Word counts summed over a part of the task."""
    held: dict[str, int] = {}

    def emit():
        names, counts = list(held), list(held.values())
        for lo in range(0, len(names), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(names[lo: lo + 100_000], pa.string()), pa.array(counts[lo: lo + 100_000], pa.int64())], schema=_COUNTS)

    for batch in batches:
        for key, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
            add_words(held, key, text)
            if len(held) > HELD_WORDS:
                yield from emit()
                held.clear()
    yield from emit()


def letter_counts(words: list[bytes]) -> np.ndarray:
    """One row of letter counts per word (Latin-1 bytes)."""
    size = np.array([len(w) for w in words], np.int64)
    flat = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
    place = np.where(flat < 0xC0, flat - ord("a"), flat - 0xC0 + 26) + LETTERS * np.repeat(np.arange(len(words)), size)
    out = np.bincount(place, minlength=LETTERS * len(words)).reshape(-1, LETTERS)
    most = size.max(initial=0)
    return out.astype(np.int8 if most < 60 else np.int16 if most < 16_000 else np.int64)


class KdTree:
    """A k-d tree over distinct vectors of letter counts; leaves hold rows of ``vectors``.

    With ``regions`` a node's box is the part of space that its splits leave, so that it also
    holds vectors the tree was not built from; else it is the bounding box of its vectors.
    """

    def __init__(self, vectors: np.ndarray, leaf: int, regions: bool = False):
        self.dim, self.cut, self.kids, self.low, self.high, self.leaf = [], [], [], [], [], []
        self.leaves: list[np.ndarray] = []
        top = np.iinfo(vectors.dtype).max
        self._grow(vectors, np.arange(len(vectors)), leaf, regions,
                   np.zeros(vectors.shape[1], vectors.dtype), np.full(vectors.shape[1], top, vectors.dtype))

    def _grow(self, vectors, rows, leaf, regions, low, high) -> int:
        at, some = len(self.dim), vectors[rows]
        if not regions and len(rows):
            low, high = some.min(axis=0), some.max(axis=0)
        for field in (self.dim, self.cut, self.leaf):
            field.append(-1)
        self.kids.append((-1, -1))
        self.low.append(low)
        self.high.append(high)
        if len(rows) > leaf:
            dim = int(some.var(axis=0).argmax())
            values = np.sort(some[:, dim])
            if values[0] < values[-1]:
                cut = values[(len(values) - 1) // 2]
                if cut == values[-1]:
                    cut = values[values < cut][-1]
                left = some[:, dim] <= cut
                below, above = high.copy(), low.copy()
                below[dim], above[dim] = cut, cut + 1
                self.dim[at], self.cut[at] = dim, int(cut)
                self.kids[at] = (self._grow(vectors, rows[left], leaf, regions, low, below),
                                 self._grow(vectors, rows[~left], leaf, regions, above, high))
                return at
        self.leaf[at] = len(self.leaves)
        self.leaves.append(rows)
        return at

    def home(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf whose region holds each vector."""
        out = np.zeros(len(vectors), np.int64)
        todo = [(0, np.arange(len(vectors)))]
        while todo:
            at, rows = todo.pop()
            if self.leaf[at] >= 0:
                out[rows] = self.leaf[at]
            elif len(rows):
                left = vectors[rows, self.dim[at]] <= self.cut[at]
                todo += [(self.kids[at][0], rows[left]), (self.kids[at][1], rows[~left])]
        return out

    def reach(self, queries: np.ndarray, more: int, less: int):
        """(leaf, queries) whose box holds a vector with at most ``more`` letters that the query
        lacks and ``less`` letters fewer: an L1 distance of ``more + less``, by direction."""
        todo = [(0, np.arange(len(queries)))]
        while todo:
            at, rows = todo.pop()
            q = queries[rows]
            near = ((np.maximum(self.low[at] - q, 0).sum(axis=1) <= more) & (np.maximum(q - self.high[at], 0).sum(axis=1) <= less))
            rows = rows[near]
            if len(rows):
                if self.leaf[at] >= 0:
                    yield self.leaf[at], rows
                else:
                    todo += [(kid, rows) for kid in self.kids[at]]


def _distinct(words: list[bytes]):
    """Distinct letter-count vectors, and the places of each one's words."""
    vectors = letter_counts(words)
    flat = np.ascontiguousarray(vectors).view(np.dtype((np.void, vectors.itemsize * LETTERS))).ravel()
    _, first, which = np.unique(flat, return_index=True, return_inverse=True)
    order = np.argsort(which, kind="stable")
    return vectors[first], np.split(order, np.cumsum(np.bincount(which))[:-1])


def near_pairs(queries: list[bytes], homes: list[bytes]):
    """(i, j) for every query and home word that differ by one edit.

    ``queries`` have one length and ``homes`` the same or one more. The tree finds pairs of
    letter-count vectors that one edit can explain. Their words are matched with the changed
    letter taken out at each of its places, so a pair of vectors with many anagrams costs
    their number, not its product.
    """
    if not queries or not homes:
        return
    longer = len(homes[0]) - len(queries[0])
    (q_vectors, q_words), (h_vectors, h_words) = _distinct(queries), _distinct(homes)
    used = np.flatnonzero(q_vectors.any(axis=0) | h_vectors.any(axis=0))
    q_vectors, h_vectors = q_vectors[:, used], h_vectors[:, used]
    tree = KdTree(h_vectors, LEAF_VECTORS)
    for leaf, rows in tree.reach(q_vectors, 1, 1 - longer):
        members = tree.leaves[leaf]
        step = max(1, (1 << 22) // (len(used) * len(members)))
        for lo in range(0, len(rows), step):
            some = rows[lo: lo + step]
            change = h_vectors[members][None, :, :] - q_vectors[some][:, None, :]
            x, y = np.nonzero((np.maximum(change, 0).sum(axis=2) == 1) & (np.abs(change).sum(axis=2) == 2 - longer))
            for a, b in zip(x.tolist(), y.tolist()):
                delta = change[a, b]
                yield from _in_order(queries, q_words[some[a]], homes, h_words[members[b]], _letter(used[delta.argmax()]),
                                     None if longer else _letter(used[delta.argmin()]))


def _letter(dim) -> bytes:
    return bytes([ord("a") + int(dim) if dim < 26 else 0xC0 + int(dim) - 26])


def _without(word: bytes, letter: bytes, mark: bytes) -> set[bytes]:
    """The word with each occurrence of a letter in turn replaced by ``mark``."""
    out, at = set(), word.find(letter)
    while at >= 0:
        out.add(word[:at] + mark + word[at + 1:])
        at = word.find(letter, at + 1)
    return out


def _in_order(queries, of_query, homes, of_home, gained: bytes, lost: bytes | None):
    """Pairs of words whose other letters stand in the same order; ``lost`` None: the home word is longer."""
    known: dict[bytes, list[int]] = {}
    for i in of_query.tolist():
        for rest in _without(queries[i], lost, b"\0") if lost else (queries[i],):
            known.setdefault(rest, []).append(i)
    for j in of_home.tolist():
        for rest in _without(homes[j], gained, b"\0" if lost else b""):
            for i in known.get(rest, ()):
                yield i, j


def _search_block(pdf: pd.DataFrame) -> pd.DataFrame:
    """Of one block of a cell: per word how many near words are in it, and the most frequent one."""
    words = [w.encode("latin-1") for w in pdf["word"]]
    n = pdf["n"].to_numpy()
    query, size = pdf["query"].to_numpy(), np.array([len(w) for w in words])
    homes = np.flatnonzero(~query)
    best: dict[bytes, list] = {}

    def seen(word, other, count):
        entry = best.setdefault(word, [0, -1, b""])
        entry[0] += 1
        if count > entry[1] or (count == entry[1] and other < entry[2]):
            entry[1:] = [count, other]

    for shorter in (0, 1):
        of_size = np.flatnonzero(query & (size == size[homes[0]] - shorter)) if len(homes) else homes
        for i, j in near_pairs([words[k] for k in of_size], [words[k] for k in homes]):
            i, j = of_size[i], homes[j]
            seen(words[i], words[j], int(n[j]))
            if shorter:  # words of one length meet in both directions
                seen(words[j], words[i], int(n[i]))
    return pd.DataFrame({"word": pd.Series([w.decode("latin-1") for w in best], dtype=object), "near": [e[0] for e in best.values()],
                         "form_n": [e[1] for e in best.values()], "form": pd.Series([e[2].decode("latin-1") for e in best.values()], dtype=object)})


def _deal(trees):
    """Each word at home in its cell, and as a query in every cell that may hold near words of its length or one more."""
    def run(batches):
        for pdf in batches:
            names = pdf["word"].to_numpy(dtype=object)
            words = np.array([w.encode("latin-1") for w in names], object)
            size, n = np.array([len(w) for w in words], np.int64), pdf["n"].to_numpy()
            for length in np.unique(size):
                own = np.flatnonzero(size == length)
                vectors = letter_counts(list(words[own]))
                for cells in (length, length + 1):
                    tree = trees.value.get(int(cells))
                    found = [(0, np.arange(len(own)))] if tree is None else tree.reach(vectors, 1, 1 if cells == length else 0)
                    parts = [(cell, rows, True) for cell, rows in found]
                    if cells == length:
                        home = np.zeros(len(own), np.int64) if tree is None else tree.home(vectors)
                        parts += [(cell, np.flatnonzero(home == cell), False) for cell in np.unique(home)]
                    for lo in range(0, len(parts), 64):
                        some = parts[lo: lo + 64]
                        rows = own[np.concatenate([r for _, r, _ in some])]
                        yield pd.DataFrame({"length": int(cells), "cell": np.repeat([c for c, _, _ in some], [len(r) for _, r, _ in some]),
                                            "query": np.repeat([k for _, _, k in some], [len(r) for _, r, _ in some]),
                                            "word": pd.Series(names[rows], dtype=object), "n": n[rows]})
    return run


def cell_trees(words: DataFrame, cell_words: int = CELL_WORDS, most_cells: int = MOST_CELLS) -> dict[int, KdTree]:
    """A k-d tree of cells for every length with more than ``cell_words`` words.

    Built on the driver from a sample by hash of at most ``SAMPLE_PER_CELL * most_cells`` words
    a length, for at most ``TREE_LENGTHS`` lengths: a fixed bound. The sample decides only how
    evenly cells are filled, never what is found.
    """
    counts = {r["l"]: r["c"] for r in words.where(F.length("word") <= TREE_LENGTHS).groupBy(F.length("word").alias("l"))
              .agg(F.count("*").alias("c")).where(F.col("c") > cell_words).collect()}
    if not counts:
        return {}
    wanted = {length: SAMPLE_PER_CELL * min(most_cells, -(-c // cell_words)) for length, c in counts.items()}
    rank = F.row_number().over(Window.partitionBy("l").orderBy("u", "word"))
    size = F.create_map(*[F.lit(x) for pair in wanted.items() for x in pair])
    share = F.create_map(*[F.lit(x) for length in counts for x in (length, int(min(1.0, 2 * wanted[length] / counts[length] + 100 / counts[length]) * (1 << 40)))])
    some = (words.select("word", F.length("word").alias("l"), F.pmod(F.xxhash64("word"), F.lit(1 << 40)).alias("u"))
            .where(F.col("l").isin(list(counts))).where(F.col("u") < share[F.col("l")])
            .withColumn("rank", rank).where(F.col("rank") <= size[F.col("l")]))
    sample: dict[int, list[bytes]] = {}
    for r in some.select("l", "word").collect():
        sample.setdefault(r["l"], []).append(r["word"].encode("latin-1"))
    return {length: KdTree(np.unique(letter_counts(sorted(found)), axis=0), SAMPLE_PER_CELL, regions=True) for length, found in sample.items()}


def near_words(spark: SparkSession, words: DataFrame, cell_words: int = CELL_WORDS, block: int = BLOCK) -> DataFrame:
    """(word, n_near, form_n, form): per word of ``words`` (word, n) that has one, its near words and the most frequent of them.

    A tree of cells per length sends each word to its own cell and to the cells whose box one
    edit can reach; a cell is searched with a tree of its own. One edit changes at most
    two letter counts, each by one, so a word reaches few cells of a deep tree.
    A cell with more than ``block`` words or queries is cut into blocks by hash, each block of
    words against each block of queries. Blocks give counts and maxima, never pairs.
    """
    trees = spark.sparkContext.broadcast(cell_trees(words, cell_words))
    dealt = stored(spark, words.mapInPandas(_deal(trees), "length int, cell int, query boolean, word string, n long"), "dealt-words")
    cell = ["length", "cell"]
    blocks = dealt.groupBy(*cell).agg(*[F.ceil(F.count_if(side) / block).cast("int").alias(name)
                                        for name, side in (("home_blocks", ~F.col("query")), ("query_blocks", F.col("query")))])
    blocks = blocks.where("home_blocks > 0 and query_blocks > 0")
    mine = F.when(F.col("query"), F.col("query_blocks")).otherwise(F.col("home_blocks"))
    others = F.when(F.col("query"), F.col("home_blocks")).otherwise(F.col("query_blocks"))
    placed = (dealt.join(blocks, cell).withColumn("mine", F.pmod(F.xxhash64("word"), mine).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), others - 1))))
    home, query = F.when(F.col("query"), F.col("other")).otherwise(F.col("mine")), F.when(F.col("query"), F.col("mine")).otherwise(F.col("other"))
    found = (placed.select(*cell, home.alias("x"), query.alias("y"), "query", "word", "n").groupBy(*cell, "x", "y")
             .applyInPandas(_search_block, "word string, near long, form_n long, form string"))
    first = F.min(F.struct((-F.col("form_n")).alias("n"), F.col("form").alias("form")))
    return (found.groupBy("word").agg(F.sum("near").alias("n_near"), first.alias("first"))
            .select("word", "n_near", (-F.col("first.n")).alias("form_n"), "first.form"))


def roots(spark: SparkSession, forms: DataFrame) -> DataFrame:
    """(word, root) of the words with a form: where following forms ends.

    Each round jumps twice as far. A form has at least twice its word's occurrences, so
    a path is at most as long as the logarithm of the largest count.
    """
    now = stored(spark, forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "forms")
    while now.where("moved").limit(1).count():
        onward = now.select(F.col("word").alias("__at"), F.col("root").alias("__root"))
        now = stored(spark, now.join(onward, F.col("root") == F.col("__at"), "left")
                     .select("word", F.coalesce("__root", "root").alias("root"), F.col("__root").isNotNull().alias("moved")), "forms")
    return now.select("word", "root")


def spelling_variants(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text",
                      cell_words: int = CELL_WORDS, block: int = BLOCK) -> DataFrame:
    """The words of all documents with their near words, form and root.

    Occurrences are summed in the tasks first, so a word that a third of all rows hold sends
    one row per task. Returns word, n, n_near, form, form_n and root.

    Defined cases: a null text has no words; a null key is written as the empty text in the checksum
    that decides left-out letters; repeated rows count again; an empty table, or one without
    frequent words, gives no rows; runs of any length take part; other columns, whatever
    their names, are not used.
    """
    rows = docs.where(F.col(text).isNotNull()).select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id"), F.col(text).alias("text"))
    counts = rows.mapInArrow(_count_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    words = stored(spark, counts.where(F.col("n") >= LEAST_COUNT), "words")
    near = near_words(spark, words, cell_words, block)
    known = F.col("form_n") >= FORM_RATIO * F.col("n")
    out = stored(spark, words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(known, F.col("form")).alias("form"), F.when(known, F.col("form_n")).alias("form_n")), "near-words")
    ends = roots(spark, out.where("form is not null"))
    return out.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(spark, table(spark, sf_dir, "documents"))
