"""N-gram Jaccard join: prefix-filtered inverted lists, verified sets, linked components and all links inside them."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import give_back, maybe_in, stored, table
from quarry.llm.shingles import SIMILARITY_PERCENT, WORDS, linked, shingle_sets

#: Counters of the document-frequency sketch, as powers of two: 8 a document within these bounds. The
#: sketch only orders shingles (which of a document's lists count as short); results are the same for any size.
SKETCH_BITS = (22, 25)
_SKETCH_PARTS = 64
#: Tasks whose sketches are added up at once.
_SUMMED = 64
#: Lists up to this long are compared within themselves at once, longer ones in two rounds.
COMPARED_AT_ONCE = 16
#: An inverted list is split into cells of about this many documents.
CELL_ROWS = 8192
#: A component's classes are compared block by block: about so many classes, or so many shingles, each.
BLOCK_CLASSES = 512
BLOCK_SHINGLES = 1 << 20
#: Lists (shingles) whose occurrences are counted at once.
_LISTS_AT_ONCE = 8192


def required_overlap(n_a, n_b):
    """T: how many shingles sets of these sizes must share to be linked."""
    p = SIMILARITY_PERCENT
    return -(-p * (n_a + n_b) // (100 + p))


def short_lists(n: int) -> int:
    """How many of a document's n lists must be built so that no partner is missed.

    A partner shares at least ceil(0.75 n) shingles, so it appears in at least one list
    when all but the ceil(0.75 n) - 1 longest are built.
    """
    return n - -(-SIMILARITY_PERCENT * n // 100) + 1 if n else 0


def _slot(shingles: np.ndarray, counters: int) -> np.ndarray:
    return (shingles & np.uint64(counters - 1)).astype(np.int64)


def _as_long(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _batches(texts: pd.Series, step: int = 512):
    values = [t if isinstance(t, str) else "" for t in texts]
    for lo in range(0, len(values), step):
        yield lo, shingle_sets(values[lo: lo + step])


def _describe(counters: int):
    """Per document its set's size and digest; at the end of a task, its sketch counters."""
    def run(batches):
        seen = np.zeros(counters, np.uint32)
        task, empty = TaskContext.get().partitionId(), None
        for pdf in batches:
            n, digest = [], []
            for _, sets in _batches(pdf["text"]):
                for s in sets:
                    n.append(len(s))
                    digest.append(int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True))
                for x in sets:
                    np.add.at(seen, _slot(x, counters), 1)
            yield pd.DataFrame({"id": pdf["id"].to_numpy(), "row": pdf["row"].to_numpy(), "row2": pdf["row2"].to_numpy(),
                                "n": n, "cls": digest, "part": empty, "task": empty, "counts": empty})
        for p, part in enumerate(np.split(seen, _SKETCH_PARTS)):
            if part.any():
                yield pd.DataFrame({"id": [empty], "row": [empty], "row2": [empty], "n": [empty], "cls": [empty], "part": [p], "task": [task],
                                    "counts": [zlib.compress(part.astype("<u8").tobytes(), 1)]})
        give_back()
    return run


def _sum_parts(key, pdf):
    total = 0
    for c in pdf["counts"]:
        total = total + np.frombuffer(zlib.decompress(c), "<u8")
    return pd.DataFrame({"part": [key[0]], "task": [key[1]], "counts": [zlib.compress(total.astype("<u8").tobytes(), 1)]})


def _sketch(parts: DataFrame, counters: int) -> np.ndarray:
    """All tasks' counters added up: ``_SUMMED`` tasks' slices at a time, then of these sums as many again."""
    tasks = (parts.agg(F.max("task")).first()[0] or 0) + 1
    while tasks > 1:
        parts = parts.groupBy("part", F.expr(f"cast(task div {_SUMMED} as int)").alias("task")).applyInPandas(_sum_parts, "part int, task int, counts binary")
        tasks = -(-tasks // _SUMMED)
    counts = np.zeros(counters, np.uint32)
    width = counters // _SKETCH_PARTS
    for r in parts.collect():  # a sketch of bounded size, not one entry per document
        counts[r["part"] * width: (r["part"] + 1) * width] = np.minimum(np.frombuffer(zlib.decompress(r["counts"]), "<u8"), 0xFFFFFFFF)
    return counts


def _postings(sketch, cell_rows: int):
    """Per document class its short lists: shingle, cell, class, size, place in the order,
    and whether the place is too late for the smaller set of a linked pair.

    A shingle that the sketch counts more than ``cell_rows`` times above its mean is dealt
    to several cells, from 1 on; cell 0 is a list that is not split.
    """
    def run(batches):
        counts, done = sketch.value, set()
        mean = counts.mean()
        for pdf in batches:
            for _, sets in _batches(pdf["text"]):
                out = []
                for s in sets:
                    if not len(s):
                        continue
                    cls = int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)
                    if (cls, len(s)) in done:
                        continue
                    done.add((cls, len(s)))
                    c = counts[_slot(s, len(counts))]
                    order = np.lexsort((s, c))[: short_lists(len(s))]
                    late = np.arange(len(order)) > len(s) - required_overlap(len(s), len(s))
                    cells = 1 + np.maximum(c[order] - mean, 0).astype(np.int64) // cell_rows
                    out.append((s[order], np.where(cells > 1, 1 + (cls >> 7) % cells, 0), np.full(len(order), cls), np.full(len(order), len(s)), np.arange(len(order)), late))
                if out:
                    shingle, cell, cls, n, at, late = (np.concatenate(x) for x in zip(*out))
                    yield pd.DataFrame({"shingle": _as_long(shingle), "cell": cell.astype(np.int32), "cls": cls,
                                        "n": n.astype(np.int32), "at": at.astype(np.int32), "late": late.astype(np.int8)})
        give_back()
    return run


def may_link(n, m, n_at, m_at):
    """Whether sets of sizes n, m whose first shared shingle is at these places may be linked."""
    return (100 * np.minimum(n, m) >= SIMILARITY_PERCENT * np.maximum(n, m)) & (np.minimum(n - n_at, m - m_at) >= required_overlap(n, m))


def _lists(batches):
    """What rows sorted by (shingle, cell, late, at), that is inverted lists, have to offer.

    A list whose first row is late holds no linked pair (the smaller set of one is never
    late). Lists of up to ``COMPARED_AT_ONCE`` rows give their pairs that may be linked.
    Longer ones, and cells of split lists, give each row with the list's first row as
    centre. Of a batch's last list at most that many rows wait for the next batch.
    """
    fields = ("shingle", "cell", "late", "cls", "n", "at")
    held, centre = None, None

    def pairs_of(x, run, short):
        out = []
        for d in range(1, COMPARED_AT_ONCE):
            if d >= len(run):
                break
            i = np.flatnonzero(short[d:] & (run[d:] == run[:-d]))
            if not len(i):
                break
            j = i + d
            ok = may_link(x["n"][i], x["n"][j], x["at"][i], x["at"][j]) & ((x["cls"][i] != x["cls"][j]) | (x["n"][i] != x["n"][j]))
            i, j = i[ok], j[ok]
            out.append(pd.DataFrame({"cls": x["cls"][j], "n": x["n"][j], "c_cls": x["cls"][i], "c_n": x["n"][i]}))
        kinds = {"cls": np.int64, "n": np.int32, "c_cls": np.int64, "c_n": np.int32}
        return pd.concat(out or [pd.DataFrame({c: np.zeros(0, k) for c, k in kinds.items()})]).drop_duplicates()

    def work(x, last):
        nonlocal held, centre
        new = np.ones(len(x["cls"]), bool)
        new[1:] = (x["shingle"][1:] != x["shingle"][:-1]) | (x["cell"][1:] != x["cell"][:-1])
        starts, run = np.flatnonzero(new), np.cumsum(new) - 1
        first = {c: x[c][starts][run] for c in fields}
        length = np.diff(np.append(starts, len(run)))[run]
        if centre is not None and all(centre[c] == x[c][0] for c in ("shingle", "cell")):
            length[run == 0] = COMPARED_AT_ONCE + 1
            for c in fields:
                first[c][run == 0] = centre[c]
        wait = (run == run[-1]) & (length <= COMPARED_AT_ONCE) & (not last)
        held = {c: v[wait] for c, v in x.items()} if wait.any() else None
        centre = None if held else {c: first[c][-1] for c in fields}
        long_ = (length > COMPARED_AT_ONCE) | (x["cell"] > 0)
        alive = ~wait & (first["late"] == 0)
        pairs = pairs_of(x, run, alive & ~long_)
        rows = pd.DataFrame({"shingle": x["shingle"], "cell": x["cell"], "cls": x["cls"], "n": x["n"], "at": x["at"],
                             "late": x["late"], "c_cls": first["cls"], "c_n": first["n"], "c_at": first["at"]})[~wait & long_ & (alive | (x["cell"] > 0))]
        return pd.concat([rows.astype({"shingle": "Int64", "cell": "Int32", "at": "Int32", "late": "Int8", "c_at": "Int32"}), pairs])[
            ["shingle", "cell", "cls", "n", "at", "late", "c_cls", "c_n", "c_at"]]

    for pdf in batches:
        if len(pdf):
            x = {c: pdf[c].to_numpy() for c in fields}
            yield work(x if held is None else {c: np.concatenate([held[c], v]) for c, v in x.items()}, False)
    if held is not None:
        yield work(held, True)


def overlap_divide_skip(query: np.ndarray, other: np.ndarray, need: int) -> int:
    """How many members of sorted ``query`` are in sorted ``other``; -1 once ``need`` is out of reach.

    Both are full shingle sets. The shorter one's first members, so many that a partner
    shares one of them, are looked up first; the rest only if one was found.
    """
    if len(query) > len(other):
        query, other = other, query
    head = len(query) - need + 1
    if head <= 0:
        return -1
    place = np.searchsorted(other, query[:head])
    found = int(np.count_nonzero(other[np.minimum(place, len(other) - 1)] == query[:head]))
    if not found:
        return -1
    place = np.searchsorted(other, query[head:])
    if len(place):
        found += int(np.count_nonzero(other[np.minimum(place, len(other) - 1)] == query[head:]))
    return found if found >= need else -1


def _verify(batches):
    for pdf in batches:
        ok = np.zeros(len(pdf), bool)
        for lo in range(0, len(pdf), 256):
            part = pdf.iloc[lo: lo + 256]
            texts = list(dict.fromkeys(part["text_a"].tolist() + part["text_b"].tolist()))
            sets = dict(zip(texts, shingle_sets(texts)))
            for i, (a, b) in enumerate(zip(part["text_a"], part["text_b"])):
                x, y = sets[a], sets[b]
                common = overlap_divide_skip(x, y, int(required_overlap(len(x), len(y))))
                ok[lo + i] = common >= 0 and bool(linked(common, len(x), len(y)))
        yield pdf.loc[ok, ["a_cls", "a_n", "b_cls", "b_n"]]
    give_back()


def connected_components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (a, b); component is the least node reachable.

    Alternating large-star and small-star steps until nothing changes: every step sends a
    node's larger neighbours to its least one, so rounds grow with the logarithm of the
    component size. Minima are aggregated map-side; a hub is an ordinary group key.
    """
    def both(e):
        return e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def star(pairs, keep):
        least = pairs.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        step = pairs.join(least, "a").where(keep)
        return step.select(F.col("b").alias("a"), F.col("m").alias("b"))

    now = stored(spark, edges.select("a", "b").where("a <> b").distinct(), "links")
    while True:
        large = star(both(now), F.col("b") > F.col("a")).where("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        joined = down.join(least, "a")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(joined.select("a", F.col("m").alias("b")))
        after = stored(spark, small.where("a <> b").distinct(), "links")
        changed = after.exceptAll(now).limit(1).count() or now.exceptAll(after).limit(1).count()
        now = after
        if not changed:
            break
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def _node(cls: str, n: str):
    """A class as one comparable value: its digest and its size."""
    return F.struct(F.col(cls).alias("cls"), F.col(n).alias("n"))


def occurrences(xs: list[np.ndarray], ys: list[np.ndarray] | None = None) -> np.ndarray:
    """How many lists hold each of ``xs`` together with each of ``ys`` (with each other if None).

    Lists of one side only are left out; the others are merged as presence matrices.
    """
    def flat(sets):
        return np.concatenate([*sets, np.zeros(0, np.uint64)]), np.repeat(np.arange(len(sets)), [len(s) for s in sets])

    def present(at, rows, height, lo, hi):
        i, j = np.searchsorted(at, [lo, hi])
        out = np.zeros((height, hi - lo), np.float32)
        out[rows[i:j], at[i:j] - lo] = 1
        return out

    sides = [flat(xs)] + ([flat(ys)] if ys is not None else [])
    if ys is None:
        values, times = np.unique(sides[0][0], return_counts=True)
        shared = values[times > 1]
    else:
        shared = np.intersect1d(sides[0][0], sides[1][0])
    placed = []
    for values, rows in sides:
        keep = np.isin(values, shared)
        at, rows = np.searchsorted(shared, values[keep]), rows[keep]
        order = np.argsort(at, kind="stable")
        placed.append((at[order], rows[order]))
    total = np.zeros((len(xs), len(xs if ys is None else ys)), np.int64)
    for lo in range(0, len(shared), _LISTS_AT_ONCE):
        hi = min(lo + _LISTS_AT_ONCE, len(shared))
        x = present(*placed[0], len(xs), lo, hi)
        y = x if ys is None else present(*placed[1], len(ys), lo, hi)
        total += (x @ y.T).astype(np.int64)
    return total


def _linked_in_blocks(pdf: pd.DataFrame):
    """(rows of block x, rows of block y, matrix of links) of one pair of blocks; a block with itself gives each pair once."""
    sets = shingle_sets(pdf["text"].tolist())
    n = np.array([len(s) for s in sets])
    first = (pdf["block"] == pdf["x"]).to_numpy()
    i, j = np.flatnonzero(first), np.flatnonzero(~first)
    same = pdf["x"].iloc[0] == pdf["y"].iloc[0]
    common = occurrences([sets[k] for k in i], None if same else [sets[k] for k in j])
    j = i if same else j
    ok = linked(common, n[i][:, None], n[j][None, :])
    return i, j, np.triu(ok, 1) if same else ok


def _block_links(pdf: pd.DataFrame) -> pd.DataFrame:
    i, j, ok = _linked_in_blocks(pdf)
    x, y = np.nonzero(ok)
    cls, n = pdf["cls"].to_numpy(), pdf["n"].to_numpy()
    a, b = i[x], j[y]
    swap = (cls[a] > cls[b]) | ((cls[a] == cls[b]) & (n[a] > n[b]))
    a, b = np.where(swap, b, a), np.where(swap, a, b)
    return pd.DataFrame({"a_cls": cls[a], "a_n": n[a], "b_cls": cls[b], "b_n": n[b]})


def _block_counts(pdf: pd.DataFrame) -> pd.DataFrame:
    i, j, ok = _linked_in_blocks(pdf)
    copies, found = pdf["copies"].to_numpy(), np.zeros(len(pdf), np.int64)
    found[i] += ok @ copies[j]
    found[j] += ok.T @ copies[i]
    return pd.DataFrame({"cls": pdf["cls"], "n": pdf["n"], "others": found})


def all_links(spark: SparkSession, classes: DataFrame, links: DataFrame, reps: DataFrame, base: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every link between classes of one component, given ``links`` that connect the components.

    ``classes`` holds node, component, least_id and copies (rows of the class). Returns
    (node, component_id, n_links) and the links. ``n_links`` counts the other rows that a
    row of the class is linked with, copies included.

    A component whose classes are all linked with each other already is complete. Of every other one all pairs of
    classes are compared, block of classes against block of classes: each task
    gets two blocks' texts once and counts the occurrences of all its pairs together, so
    no text is joined to a pair. Counting gives sums per class and pair of blocks; the pairs
    themselves are made only when the second result is used.
    """
    sized = (classes.groupBy("component").agg(F.min("least_id").alias("component_id"), F.count("*").alias("size"),
                                              F.sum("copies").alias("rows"), F.sum("node.n").alias("shingles")))
    known = (links.distinct().join(classes.select("node", "component"), F.col("node") == _node("a_cls", "a_n"))
             .groupBy("component").agg(F.count("*").alias("known")))
    sized = stored(spark, sized.join(known, "component", "left")
                   .withColumn("complete", F.coalesce("known", F.lit(0)) == F.col("size") * (F.col("size") - 1) / 2), "components")
    blocks = F.ceil(F.greatest(F.col("size") / BLOCK_CLASSES, F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    members = (classes.select("node", "component", "copies").join(sized.where("not complete"), "component")
               .select("node.cls", "node.n", "copies", F.col("component.cls").alias("g_cls"), F.col("component.n").alias("g_n"), blocks.alias("blocks"))
               .withColumn("block", F.pmod(F.xxhash64("cls", "n"), "blocks").cast("int")).join(reps, ["cls", "n"]))
    members = stored(spark, members, "open-classes")
    dealt = (_with_texts(spark, members, base).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("x", F.least("block", "other")).withColumn("y", F.greatest("block", "other"))
             .select("g_cls", "g_n", "x", "y", "block", "cls", "n", "copies", "text").groupBy("g_cls", "g_n", "x", "y"))
    counts = (dealt.applyInPandas(_block_counts, "cls long, n int, others long")
              .groupBy(_node("cls", "n").alias("node")).agg(F.sum("others").alias("others")))
    by_class = (classes.join(sized, "component").join(counts, "node", "left")
                .select("node", "component_id", F.when(F.col("complete"), F.col("rows") - 1)
                        .otherwise(F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")))
    closed = (links.distinct().join(classes.select("node", "component"), F.col("node") == _node("a_cls", "a_n"))
              .join(sized.where("complete").select("component"), "component").select(*links.columns))
    return by_class, closed.union(dealt.applyInPandas(_block_links, "a_cls long, a_n int, b_cls long, b_n int"))


def jaccard_join(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text",
                 cell_rows: int = CELL_ROWS) -> tuple[DataFrame, DataFrame]:
    """Exact join of all documents on 5-word shingle Jaccard >= 0.75: every pair, and its groups.

    Returns (documents, links): per row ``key``, ``n_shingles``, ``component_id`` and
    ``n_links`` (the other rows it is linked with); and all verified links between classes.
    A class is the documents with one shingle set; its 64-bit digest together with the
    set's size stands for it, and its documents are linked with each other.

    ``connectivity`` finds the components, ``all_links`` the links inside them; there are
    none between components.

    Defined cases: null, empty and blank texts have no shingles and are linked with nothing
    (their component is their own key); null keys get a null component unless linked with a
    keyed row; repeated rows share a class; an empty table gives no rows; extra columns are
    not carried.
    """
    rows, classes, links, reps, base = connectivity(spark, docs, key, text, cell_rows)
    by_class, links = all_links(spark, stored(spark, classes, "classes"), links, reps, base)
    return _per_row(rows, by_class, key, F.coalesce("n_links", F.lit(0)).alias("n_links")), links


def _per_row(rows: DataFrame, by_class: DataFrame, key: str, *more) -> DataFrame:
    keyed = rows.withColumn("node", F.struct("cls", F.col("n").cast("int").alias("n")))
    return (keyed.join(by_class, "node", "left")
            .select(F.col("id").alias(key), F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"), *more))


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).alias("id"), F.xxhash64(key, text).alias("row"), F.xxhash64(F.lit(1), F.col(key), F.col(text)).alias("row2"),
                       F.col(text).alias("text"))


def representatives(rows: DataFrame) -> DataFrame:
    """(cls, n, row, row2) of one row of each class of ``rows``."""
    return (rows.where("n > 0").groupBy("cls", "n").agg(F.min(F.struct("row", "row2")).alias("rep"))
            .select("cls", "n", "rep.row", "rep.row2"))


def classes_of(rows: DataFrame, components: DataFrame) -> DataFrame:
    """(node, component, least_id, copies) of the classes of ``rows`` (id, n, cls)."""
    return (rows.where("n > 0").groupBy(F.struct("cls", F.col("n").cast("int").alias("n")).alias("node"))
            .agg(F.min("id").alias("least_id"), F.count("*").alias("copies"))
            .join(components, "node", "left").withColumn("component", F.coalesce("component", "node")))


def connectivity(spark: SparkSession, docs: DataFrame, key: str, text: str, cell_rows: int = CELL_ROWS) -> tuple[DataFrame, ...]:
    """Components of the documents under 5-word shingle Jaccard >= 0.75, exact.

    Returns rows, their classes with components, links enough to connect each component,
    one row of each class, and the texts.

    Prefix filter: shingles are ordered by a frequency sketch over all documents (ties by
    hash), and only a document's rarest ones, its short lists, make postings and are shuffled;
    passages and phrases that many documents share are not. Long lists are neither built nor probed: a
    candidate's full set is intersected instead. Two rounds look at the short lists:

    1. Lists of up to ``COMPARED_AT_ONCE`` classes are compared within themselves. In longer
       ones the centre (the class whose short list it is earliest, so with the fewest
       rare shingles) is checked against the list's other classes, and the centre of each
       cell of a split list against the whole list's: one candidate per list entry, however
       many copies there are.
    2. Classes of one longer list that round 1 left in different components are
       compared; the list's main component is not compared with itself. So large groups of copies cost
       about one check per member instead of one per pair, and every pair that could still
       join two components is checked. The smaller set of a linked pair is never late in the list of
       the first shingle they share, so late rows only meet smaller ones that are not: a passage that
       many otherwise different documents hold, late in all of them, gives no pair at all.

    Candidates must pass the size bound and the position bound (what is left after the
    shared shingle must reach T); the check itself counts the overlap of the full sets.
    """
    base = _texts(docs, key, text)
    low, high = SKETCH_BITS
    counters = 1 << max(low, min(high, (8 * docs.count()).bit_length()))
    described = stored(spark, base.mapInPandas(
        _describe(counters), f"id {docs.schema[key].dataType.simpleString()}, row long, row2 long, n long, cls long, part int, task int, counts binary"), "shingle-sizes", 2048)
    sketch = spark.sparkContext.broadcast(_sketch(described.where("part is not null").select("part", "task", "counts"), counters))
    rows = described.where("part is null").select("id", "row", "row2", "n", "cls")

    postings = base.mapInPandas(_postings(sketch, cell_rows), "shingle long, cell int, cls long, n int, at int, late byte")
    offered = stored(spark, postings.repartition("shingle", "cell").sortWithinPartitions("shingle", "cell", "late", "at", "cls")
                   .mapInPandas(_lists, "shingle long, cell int, cls long, n int, at int, late byte, c_cls long, c_n int, c_at int"), "list-pairs")
    lists = offered.where("shingle is not null")
    centres = lists.where("cell > 0 and cls = c_cls and n = c_n").select("shingle", "at", "cls", "n")
    tops = centres.groupBy("shingle").agg(F.min(F.struct("at", "cls", "n")).alias("top"))
    across = centres.join(tops, "shingle").select("cls", "n", "at", F.col("top.cls").alias("c_cls"), F.col("top.n").alias("c_n"), F.col("top.at").alias("c_at"))
    starred = lists.select("cls", "n", "at", "c_cls", "c_n", "c_at").union(across).where("cls <> c_cls or n <> c_n")
    stars = starred.where(_possible("n", "c_n", "at", "c_at")).select("cls", "n", "c_cls", "c_n")
    short = offered.where("shingle is null").select("cls", "n", "c_cls", "c_n")
    stars = _as_pairs(stars.union(short), _node("cls", "n"), _node("c_cls", "c_n"))
    reps = representatives(rows)

    checked = stored(spark, stars, "candidates")
    links = stored(spark, _check(spark, checked, reps, base), "links")
    first = connected_components(spark, _edges(links))

    # round 2: lists with classes of several components
    placed = (lists.select("shingle", "cls", "n", "at", "late").distinct().withColumn("node", _node("cls", "n"))
              .join(first, "node", "left").withColumn("component", F.coalesce("component", "node")))
    sizes = placed.groupBy("shingle", "component").agg(F.count("*").alias("size"), F.count_if(F.col("late") == 0).alias("early"))
    mains = (sizes.groupBy("shingle").agg(F.count("*").alias("parts"), F.max(F.struct("size", "component")).alias("top"),
                                          F.sum("size").alias("all"), F.sum("early").alias("early")).where("parts > 1 and early > 0")
             .select("shingle", F.col("top.component").alias("main"), F.ceil(F.col("all") / cell_rows).cast("int").alias("cells")))
    mixed = stored(spark, placed.join(mains, "shingle").withColumn("in_main", F.col("component") == F.col("main")).drop("main"), "mixed-lists")
    # a row meets the list cell by cell, so a long list is not one key
    y = mixed.select("shingle", F.pmod(F.xxhash64("cls", "n"), "cells").cast("int").alias("part"), *[F.col(c).alias("y_" + c) for c in ("node", "n", "at", "late", "component", "in_main")])
    x = mixed.where("late = 0").select("shingle", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)).alias("part"),
                                       *[F.col(c).alias("x_" + c) for c in ("node", "n", "at", "component", "in_main")])
    met = (x.where("not x_in_main").join(y, ["shingle", "part"])
           .unionByName(x.where("x_in_main").join(y.where("not y_in_main"), ["shingle", "part"])))
    near = (met.where("x_component <> y_component and (x_n < y_n or (x_n = y_n and y_late = 0 and x_node < y_node))")
            .where(_possible("x_n", "y_n", "x_at", "y_at")))
    rest = stored(spark, _as_pairs(near, F.col("x_node"), F.col("y_node")).join(checked, checked.columns, "left_anti"), "candidates")
    links = stored(spark, links.union(_check(spark, rest, reps, base)), "links")
    components = connected_components(spark, _edges(links))

    return rows, classes_of(rows, components), links, reps, base


def _possible(n: str, m: str, n_at: str, m_at: str) -> str:
    """SQL: sets of sizes n, m whose first shared shingle is at these places may be linked."""
    need = f"ceil({SIMILARITY_PERCENT} * ({n} + {m}) / {100 + SIMILARITY_PERCENT})"
    return (f"100 * least({n}, {m}) >= {SIMILARITY_PERCENT} * greatest({n}, {m}) "
            f"and least({n} - {n_at}, {m} - {m_at}) >= {need}")


def _as_pairs(df: DataFrame, one, other) -> DataFrame:
    pairs = df.select(F.least(one, other).alias("p"), F.greatest(one, other).alias("q")).distinct()
    return pairs.select(F.col("p.cls").alias("a_cls"), F.col("p.n").alias("a_n"), F.col("q.cls").alias("b_cls"), F.col("q.n").alias("b_n"))


def _edges(links: DataFrame) -> DataFrame:
    return links.select(_node("a_cls", "a_n").alias("a"), _node("b_cls", "b_n").alias("b"))


def _check(spark: SparkSession, pairs: DataFrame, reps: DataFrame, base: DataFrame) -> DataFrame:
    """The candidate pairs whose full sets are similar enough, from one text of each class.
    """
    sides = [pairs.select("*", F.lit(s).alias("side"), F.col(s + "_cls").alias("cls"), F.col(s + "_n").cast("long").alias("n")) for s in "ab"]
    members = stored(spark, sides[0].union(sides[1]).join(reps, ["cls", "n"]).drop("cls", "n"), "members")
    both = (_with_texts(spark, members, base).groupBy(*pairs.columns)
            .agg(*[F.max(F.when(F.col("side") == s, F.col("text"))).alias("text_" + s) for s in "ab"]))
    return both.mapInPandas(_verify, "a_cls long, a_n int, b_cls long, b_n int")


def _with_texts(spark: SparkSession, members: DataFrame, base: DataFrame) -> DataFrame:
    """``members`` (stored, with ``row``) with their texts.

    A row is known by 128 bits of hashes of key and text, the same in every scan, and repeated
    rows count once. The scan leaves out most texts that are not wanted (``maybe_in``), so the
    join shuffles few of them.
    """
    may_be_wanted = maybe_in(spark, members, "row")
    texts = base.select("row", "row2", "text").where(may_be_wanted(F.col("row"))).groupBy("row", "row2").agg(F.max("text").alias("text"))
    return members.join(texts, ["row", "row2"])


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(spark, table(spark, sf_dir, "documents"))[0]


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each group of linked documents the one with the smallest id stays.

    Rows without a key stay, and so do all rows that carry a group's smallest key.
    """
    rows, classes, *_ = connectivity(spark, docs, "doc_id", "text")
    least = classes.groupBy("component").agg(F.min("least_id").alias("component_id"))
    found = _per_row(rows, classes.join(least, "component").select("node", "component_id"), "doc_id")
    dropped = found.where("component_id < doc_id").select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)
