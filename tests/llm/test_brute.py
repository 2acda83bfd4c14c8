"""Operators that SQL cannot express, against brute-force versions on small inputs; the pipeline as a chain of such versions."""

import collections
import re
import zlib

import numpy as np
import pytest
import xxhash
from conftest import SF_SMALL
from pyspark.sql import functions as F
from test_operators import LONG, ODD, brute_components, family, frame, saved

from quarry.llm import boosting as B
from quarry.llm import exact_dedup as D
from quarry.llm import language as L
from quarry.llm import minhash as M
from quarry.llm import ngram_join as J
from quarry.llm import packing as P
from quarry.llm import quality as Q
from quarry.llm import sharding as S
from quarry.llm.shingles import shingle_sets

FOREIGN = ["Это русский текст, который модель никогда не видела раньше, и он довольно длинный.",
           "日本語の文章です。これは長い文章です、そして未知の言語です。", "Η ελληνική γλώσσα είναι άγνωστη σε αυτό το μοντέλο"]


def test_maybe_in_passes_every_member_and_few_others(spark, tmp_dir):
    from quarry.llm.common import maybe_in
    spark.range(0, 3000, 3).select((F.xxhash64("id")).alias("h")).write.parquet(f"{tmp_dir}/m")
    test = maybe_in(spark, spark.read.parquet(f"{tmp_dir}/m"), "h")
    got = {r.id for r in spark.range(9000).where(test(F.xxhash64("id"))).collect()}
    assert got >= set(range(0, 3000, 3)) and len(got) < 2200
    spark.createDataFrame([], "h long").write.parquet(f"{tmp_dir}/none")
    nothing = maybe_in(spark, spark.read.parquet(f"{tmp_dir}/none"), "h")
    assert spark.range(100).where(nothing(F.xxhash64("id"))).count() == 0


# op2
def test_dedup_of_many_repeated_rows(spark):
    rows = [(None, None, "en", "s1")] * 40 + [(3, " a  b", "en", "s1")] * 30 + [(2, " a\tb", "en", "s1")] * 20 + [(9, "c", None, None), (8, "d", None, None)]
    got = D.exact_dedup(spark, frame(spark, rows).repartition(7)).collect()
    assert len(got) == len(rows)
    kept = collections.Counter((r.doc_id, r.keep_id, r.group_size) for r in got if r.kept)
    assert kept == {(None, None, 40): 1, (2, 2, 50): 1, (9, 9, 1): 1, (8, 8, 1): 1}
    with pytest.raises(ValueError, match="reserved"):
        D.exact_dedup(spark, frame(spark, rows).withColumn("__full", F.lit(1)))


# op4
def test_margins_equal_exact_kernel_ridge(monkeypatch):
    """With every sample row a landmark, the features are exact: the dual solution must give the same margins."""
    rng = np.random.default_rng(3)
    words = {"x": ["ban", "odo", "lumi", "tera"], "y": ["ska", "grun", "oft", "weil"], "z": ["tion", "que", "ais", "oux"]}
    texts, languages = [], []
    for name, some in words.items():
        for _ in range(9):
            texts.append(" ".join(rng.choice(some, 12)) + f" {rng.integers(1000)}")
            languages.append(name)
    x = L.spectra(texts)
    weights = rng.random(len(texts)) + 0.5
    model = L.LanguageModel(np.packbits(x, axis=1), languages, np.arange(len(texts)), weights)
    new = L.spectra(["ban lumi ska", "grun oft weil que", "tion ais", LONG[:300]])

    def kernel(a, b):
        a, b = a.astype(float), b.astype(float)
        return (a @ b.T) / np.sqrt(a.sum(1)[:, None] * b.sum(1)[None, :])
    n, k = len(texts), kernel(x, x)
    w = np.diag(weights / weights.mean())
    y = np.where(np.array(languages)[:, None] == np.array(sorted(words))[None, :], 1.0, -1.0)
    # W (K a + b - y) + ridge n a = 0 and sum of the weighted errors = 0
    left = np.block([[w @ k + L.RIDGE * n * np.eye(n), w.sum(1)[:, None]], [(w @ k).sum(0)[None, :], np.array([[w.sum()]])]])
    right = np.vstack([w @ y, (w @ y).sum(0)[None, :]])
    solved = np.linalg.solve(left, right)
    want = kernel(new, x) @ solved[:-1] + solved[-1]
    assert np.abs(model.judge(new)[0] - want).max() < 2e-3


def test_language_stage_rejects_by_the_model_and_keeps_unlabelled_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    letters = {r.doc_id for r in docs.collect() if any(map(str.isalpha, r.text or ""))}
    more = spark.createDataFrame([(10_000 + i, t) for i, t in enumerate([*FOREIGN, "123 !!", None, ""])], "doc_id long, text string")
    mixed = docs.unionByName(more, allowMissingColumns=True)
    stage = L.documents_in_a_language
    assert {r.doc_id for r in stage(spark, mixed, "").collect()} == letters
    unlabelled = mixed.withColumn("lang", F.lit(None).cast("string"))
    kept = stage(spark, unlabelled, "")
    assert kept.columns == mixed.columns
    assert {r.doc_id for r in kept.collect()} == letters | {10_000 + i for i in range(len(FOREIGN))}


def test_language_familiarity_of_one_language(spark):
    rows = [(i, f"the quick brown fox {i} jumps over the lazy dog", "en", "s") for i in range(30)] + [(99, FOREIGN[0], None, "s")]
    assert {r.doc_id for r in L.documents_in_a_language(spark, frame(spark, rows), "").collect()} >= set(range(30))


# op5
def template(n, common=20, own=3):
    """Texts of one passage and a few words of their own: sharing nearly enough, never linked."""
    passage = " ".join(f"p{i}" for i in range(common))
    return [(i, f"{passage} {' '.join(f'o{i}x{k}' for k in range(own))}") for i in range(n)]


def test_join_of_a_common_passage_offers_no_pairs(spark, monkeypatch):
    seen = []
    plain = J.stored
    monkeypatch.setattr(J, "stored", lambda sp, df, name, *more: seen.append((name, plain(sp, df, name, *more))) or seen[-1][1])
    rows = template(600) + family(20, 60, 2, 9, 1000)
    got = J.jaccard_join(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(3), cell_rows=64)[0]
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute_components(rows)
    offered = [df.count() for name, df in seen if name == "candidates"]
    assert len(offered) == 2 and sum(offered) < 200


def test_sketch_adds_up_over_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(J, "_SUMMED", 3)
    texts = [(i, f"a b c d e f{i % 5} g h") for i in range(40)]
    base = J._texts(spark.createDataFrame(texts, "doc_id long, text string").repartition(11), "doc_id", "text")
    rows = base.mapInPandas(J._describe(1 << 12), "id long, row long, row2 long, n long, cls long, part int, task int, counts binary").where("part is not null")
    got = J._sketch(rows.select("part", "task", "counts"), 1 << 12)
    want = np.zeros(1 << 12, np.int64)
    for s in shingle_sets([t for _, t in texts]):
        np.add.at(want, J._slot(s, 1 << 12), 1)
    assert (got == want).all()


# op6
def test_fingerprints_equal_naive_minhash(spark):
    got = {r.doc_id: r for r in M.op6_minhash_fingerprints(spark, SF_SMALL).collect()}
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    a, b = (x.tolist() for x in M.permutations())
    order = sorted(texts)
    for i in order[::9]:
        for text, found in ((texts[i], got[i].fingerprint),):
            marks = shingle_sets([text])[0].tolist()
            low = [min((((s * x + y) % (1 << 64)) >> 32 for s in marks), default=0xFFFFFFFF) & 0xFFFF for x, y in zip(a, b)]
            assert found == "".join(f"{m:04x}" for m in low)
    for i, j in zip(order, order[1:] + order[:1]):
        def near(x, y):
            return np.mean([x[k:k + 4] == y[k:k + 4] for k in range(0, len(x), 4)])
        assert got[i].near_next == near(got[i].fingerprint, got[j].fingerprint)
        assert got[i].near_edited == near(got[i].fingerprint, got[i].edited_fingerprint)


def test_next_of_string_keys(spark):
    keys = ["b", "a", "é", "Z", "zz", "日", "", "a1", None, "c"] + [f"k{i:03d}" for i in range(40)]
    df = spark.createDataFrame([(k, f"text {k}") for k in keys], "k string, text string").repartition(5)
    want = sorted(keys, key=lambda k: (k is not None, (k or "").encode()))
    got = {r.text: r.next_text for r in M.with_next(df, "k", "text", run_rows=7).collect()}
    assert got == {f"text {k}": f"text {n}" for k, n in zip(want, want[1:] + want[:1])}


# op7
@pytest.mark.parametrize("seed", range(4))
def test_bounded_loads_equal_a_walk_key_by_key(seed):
    rng = np.random.default_rng(seed)
    _, owner = S.ring(5, 8)
    counts = rng.integers(0, 30, len(owner)) * (rng.random(len(owner)) < 0.6)
    counts[3] = 200
    total = int(counts.sum())
    caps = total // 5 + (np.arange(5) < total % 5)
    room, want, waiting = caps.tolist(), {}, []
    for arc, n in enumerate(counts):
        for rank in range(n):
            if room[owner[arc]]:
                room[owner[arc]] -= 1
                want[arc, rank] = owner[arc]
            else:
                waiting.append((arc, rank))
    for arc, rank in waiting:
        node = arc
        while not room[owner[node]]:
            node = (node + 1) % len(owner)
        room[owner[node]] -= 1
        want[arc, rank] = owner[node]
    flow = S.bounded_flow(counts, owner, caps)
    got = {}
    for (arc, rank, shard, slot), after in zip(flow, [*flow[1:], (None, 0, 0, 0)]):
        for r in range(rank, after[1] if after[0] == arc else counts[arc]):
            got[arc, r] = shard
    assert got == want


def test_shards_of_documents_equal_the_walk(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    points, owner = S.ring(7, 16)
    arcs = collections.defaultdict(list)
    for r in rows:
        h = xxhash.xxh64_intdigest(str(r.doc_id).encode(), 42)
        h -= (h >= 1 << 63) << 64
        arcs[int(np.searchsorted(points, h)) % len(points)].append((h, r.doc_id))
    counts = np.array([len(arcs[a]) for a in range(len(points))])
    caps = len(rows) // 7 + (np.arange(7) < len(rows) % 7)
    room, want, waiting = caps.tolist(), {}, []
    for arc in range(len(points)):
        for _, i in sorted(arcs[arc]):
            if room[owner[arc]]:
                room[owner[arc]] -= 1
                want[i] = owner[arc]
            else:
                waiting.append((arc, i))
    for arc, i in waiting:
        while not room[owner[arc]]:
            arc = (arc + 1) % len(points)
        room[owner[arc]] -= 1
        want[i] = owner[arc]
    docs = spark.createDataFrame([(r.doc_id, r.text) for r in rows], "doc_id long, text string")
    got = {r.doc_id: r.shard for r in S.shard_documents(docs, shards=7, virtual_nodes=16).collect()}
    assert got == want and counts.sum() == len(rows)


# op8, op9
def gain(pairs, cut, ridge):
    """Gain of cutting (bin, gradient, curvature) rows before bin ``cut``."""
    sides = [[(g, h) for b, g, h in pairs if (b < cut) == left] for left in (True, False)]
    sums = [(sum(g for g, _ in s), sum(h for _, h in s)) for s in sides]
    if min(h for _, h in sums) < 1e-6:
        return 0.0
    g, h = sum(x[1] for x in pairs), sum(x[2] for x in pairs)
    return sum(a * a / (b + ridge) for a, b in sums) - g * g / (h + ridge)


def made_up(seed, n=60, f=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, f))
    y = (x[:, 0] + 0.5 * x[:, 1] * x[:, 2] + rng.normal(size=n) * 0.3 > 0).astype(float)
    return x, y, rng.random(n) + 0.5


def test_boosted_trees_equal_naive_search():
    x, y, w = made_up(1)
    model = B.BoostedTrees(trees=4, depth=2, bins=6).fit(x, y, w)
    w = w / w.mean()
    bins = B.to_bins(x, B.bin_edges(x, 6)).tolist()
    base = float((w * y).sum() / w.sum())
    raw = [np.log(base / (1 - base))] * len(y)
    for _ in range(4):
        p = [1 / (1 + np.exp(-r)) for r in raw]
        g, h = [wi * (yi - pi) for wi, yi, pi in zip(w, y, p)], [wi * pi * (1 - pi) for wi, pi in zip(w, p)]

        def grow(rows, depth):
            if depth == 2 or not rows:
                step = 0.15 * sum(g[i] for i in rows) / (sum(h[i] for i in rows) + 2.0)
                for i in rows:
                    raw[i] += step
                return
            best = (1e-3, None, None)
            for f in range(3):
                for cut in range(1, 7):
                    some = gain([(bins[i][f], g[i], h[i]) for i in rows], cut, 2.0)
                    if some > best[0] + 1e-12:
                        best = (some, f, cut)
            _, f, cut = best
            grow([i for i in rows if f is None or bins[i][f] < cut], depth + 1)
            grow([i for i in rows if f is not None and bins[i][f] >= cut], depth + 1)
        grow(list(range(len(y))), 0)
    assert np.allclose(model.raw(x), raw, atol=1e-9)


def test_additive_model_equals_naive_fit(monkeypatch):
    for name, value in (("ROUNDS", 2), ("PAIRS", 1), ("PAIR_ROUNDS", 1), ("BINS", 5), ("PAIR_BINS", 3)):
        monkeypatch.setattr(Q, name, value)
    x, y, w = made_up(2)
    model = Q.AdditiveModel().fit(x, y, w)
    w = w / w.mean()
    fine, coarse = B.to_bins(x, B.bin_edges(x, 5)), B.to_bins(x, B.bin_edges(x, 3))
    base = float((w * y).sum() / w.sum())
    raw = np.full(len(y), np.log(base / (1 - base)))

    def slopes():
        p = 1 / (1 + np.exp(-raw))
        return w * (y - p), w * p * (1 - p)

    def value(rows, g, h):
        return g[rows].sum() / (h[rows].sum() + Q.RIDGE)

    def best_cut(rows, b, g, h, cuts):
        found = (0.0, None)
        for cut in cuts:
            some = gain(list(zip(b[rows], g[rows], h[rows])), cut, Q.RIDGE)
            if some > found[0] + 1e-12:
                found = (some, cut)
        return found[1]
    for _ in range(2):
        for f in range(3):
            g, h = slopes()
            b, rows = fine[:, f], np.arange(len(y))
            first = best_cut(rows, b, g, h, range(1, 6))
            halves = [rows[b < first], rows[b >= first]] if first else [rows]
            for half, cuts in zip(halves, [range(1, first), range(first + 1, 6)] if first else [range(1, 6)]):
                cut = best_cut(half, b, g, h, cuts)
                for part in ([half[b[half] < cut], half[b[half] >= cut]] if cut else [half]):
                    raw[part] += Q.RATE * value(part, g, h)

    def two_way(i, j):
        """Gain and leaves of cutting one of two features, then each side by the other."""
        g, h = slopes()
        best, leaves = 0.0, []
        for a, b in ((coarse[:, i], coarse[:, j]), (coarse[:, j], coarse[:, i])):
            for at in range(1, 4):
                parts = []
                for side in (np.flatnonzero(a < at), np.flatnonzero(a >= at)):
                    cut = best_cut(side, b, g, h, range(1, 4))
                    parts += [side[b[side] < cut], side[b[side] >= cut]] if cut else [side]
                total = sum(g[p].sum() ** 2 / (h[p].sum() + Q.RIDGE) for p in parts)
                if total > best + 1e-12:
                    best, leaves = total, parts
        return best, leaves, g, h
    pairs = [(0, 1), (0, 2), (1, 2)]
    best = min(pairs, key=lambda ij: (-two_way(*ij)[0], ij))
    assert model.pairs == [best]
    _, leaves, g, h = two_way(*best)
    for part in leaves:
        raw[part] += Q.RATE * value(part, g, h)
    assert np.allclose(model.raw(x), raw, atol=1e-9)


# op10
def test_packing_is_the_same_for_any_cells(spark, tmp_dir):
    spark.createDataFrame([(i, 0, i, 7 + i % 3) for i in range(500)], "doc_id long, piece int, ids_crc32 long, length long").write.parquet(f"{tmp_dir}/p")
    pieces = spark.read.parquet(f"{tmp_dir}/p")
    for cells in (None, 1, 7):
        rooms = collections.defaultdict(list)
        for r in P.assign_sequences(spark, pieces, capacity=32, cells=cells).collect():
            rooms[r.sequence_id].append((r.offset, r.length))
        for v in rooms.values():
            v.sort()
            assert v[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(v, v[1:])) and sum(n for _, n in v) <= 32
        assert len(rooms) == 139 and sum(map(len, rooms.values())) == 500


# the pipeline
def test_run_equals_chained_brute_force(spark, tmp_dir):
    import corpus_pipeline
    import duckdb
    from tokenizers import Tokenizer

    from quarry.llm.catalog import ORACLE
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "lang", "source").collect()]
    rows += [(5000 + i, t.replace(" ", "\t \n"), x, s) for i, (_, t, x, s) in enumerate(rows[:9]) if t]
    rows += [(6000 + i, t, None, "src1") for i, t in enumerate([*FOREIGN, None, "", "12 34 !", "abc"])]
    rows += [(i, t, "en", "src2") for i, t in family(12, 90, 3, 5, 7000)]
    frame(spark, rows).select("doc_id", "text", "lang", "source", "n_chars").repartition(3).write.parquet(f"{tmp_dir}/documents.parquet")
    got = collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in corpus_pipeline.run(spark, tmp_dir).collect())

    known = [r for r in rows if any(map(str.isalpha, r[1] or "")) and r[1] not in FOREIGN]
    unique = {}
    for r in sorted(known, key=lambda r: r[0]):
        unique.setdefault(re.sub(r"[\x20\x09-\x0d]+", " ", r[1]), r)
    groups = brute_components([r[:2] for r in unique.values()])
    alone = [r for r in unique.values() if groups[r[0]][1] == r[0]]
    assert len(rows) > len(known) > len(unique) > len(alone)

    con = duckdb.connect()
    spark.createDataFrame(alone, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_dir}/alone")
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_dir}/alone/*.parquet')")
    taken = {r[0]: r[1] for r in con.sql(f"SELECT doc_id, taken FROM ({ORACLE['op3_curriculum_mix']})").fetchall()}
    tokenizer = Tokenizer.from_file(P.default_tokenizer())
    want = collections.Counter()
    for i, text, *_ in alone:
        words = re.findall(r"[^\x20\x09-\x0d]+", text)
        left = taken[i]
        while left > 0:
            some = text if left >= len(words) else " ".join(words[:left])
            left -= len(words)
            ids = np.array(tokenizer.encode(some, add_special_tokens=False).ids + [0], "<u4")
            for p, s in enumerate(range(0, len(ids), 2048)):
                want[i, p, s, len(ids[s:s + 2048]), zlib.crc32(ids[s:s + 2048].tobytes())] += 1
    assert got == want


def test_words_that_go_straight_to_the_model_get_the_tokenizers_ids():
    words = [chr(c) for c in range(0x21, 0x200)] + [a + chr(c) + b for c in range(0xA0, 0x180) for a in ("", "a", "É") for b in ("", "x", "..", "'s", "'")]
    words += ["don't", "a_b", "a__", "x'", "ß.", "ÆØÅ!!", "İx", "Σς", "naïve—", "9a", "a9", "a-b", "A.B.", "...", "'tis", "it's.", "$$$", "LEÇÈ%%%", "éa"]
    words = [w for w in words if w and w.strip() == w]
    ids = P.WordIds(P.default_tokenizer())
    assert ids._encode(words) == [e.ids for e in ids.tokenizer.encode_batch(words, add_special_tokens=False)]
