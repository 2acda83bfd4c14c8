"""The training-data operators on small fixtures: brute force, round trips and odd inputs."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from quarry.llm import exact_dedup as D
from quarry.llm import language as L
from quarry.llm import minhash as M
from quarry.llm import mixing as X
from quarry.llm import ngram_join as J
from quarry.llm import packing as P
from quarry.llm import quality as Q
from quarry.llm import sharding as S
from quarry.llm import toxicity as T
from quarry.llm import warc as W
from quarry.llm.shingles import shingle_sets

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, kept string, score string"
LONG = " ".join(f"w{i % 7919}" for i in range(30000))
ODD = [(1, "a b c d e f g", "en", "s1"), (1, "a b c d e f g", "en", "s1"), (2, None, None, None), (3, "", "en", "s1"),
       (4, " \t\n ", "fr", None), (None, "a  b c\td e f g", "en", "s2"), (5, LONG, "en", "s1"), (6, LONG + " x", "fr", "s2"),
       (7, "12345 !!!", None, "s2"), (8, "Ünï cödé ☃ \x00 text", "de", "s3"), (9, "a b c d e f h", "en", "s1"), (None, None, None, None)]


def frame(spark, rows):
    return spark.createDataFrame([(r + (None, 99, "x", "y")) for r in rows], SCHEMA)


def saved(spark, tmp_dir, rows, name="documents"):
    path = f"{tmp_dir}/{name}.parquet"
    frame(spark, rows).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def texts(documents):
    return {r.doc_id: r.text or "" for r in documents.select("doc_id", "text").collect()}


@pytest.mark.parametrize("name", ["op1_warc_segments", "op2_exact_dedup", "op3_curriculum_mix"])
def test_oracles(spark, name):
    from oracle_check import compare, duck

    from quarry.llm.catalog import ORACLE, QUERIES
    r = compare(spark, duck(SF_SMALL), name, QUERIES[name], ORACLE[name], SF_SMALL)
    assert r["ok"], r


# op1
def test_warc_odd_pages(spark, tmp_dir):
    big = "é<p>" * 60000
    rows = [(1, "u", big), (2, "u\r\nx", big), (3, None, None), (4, "u", ""), (5, "u", "x" * 99), (6, "u", "x" * 99),
            (7, "u", "HTTP\r\n\r\nWARC/1.1\r\n\r\n0\r\n\r\n" * 9), (None, "u", big), (7, "u", "y" * 100), (7, "u", "y" * 100)]
    path = f"{tmp_dir}/pages.parquet"
    spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("record", F.lit(1)).write.parquet(path)
    got = W.op1_warc_segments(spark, tmp_dir).collect()
    assert len(got) == len(rows)
    by = collections.defaultdict(list)
    for r in got:
        by[r.page_id].append(r)
    assert by[1][0].payload_bytes == len(big.encode()) and by[1][0].payload_digest == hashlib.sha256(big.encode()).hexdigest()
    assert [(by[k][0].record_type, by[k][0].refers_to) for k in (1, 2, 3, 4, 5, 6, None)] == [
        ("response", None), ("revisit", 1), ("response", None), ("response", None), ("response", None), ("response", None), ("revisit", 1)]
    assert by[2][0].payload_bytes == by[1][0].payload_bytes
    assert sorted((r.payload_bytes, r.record_type, r.refers_to) for r in by[7])[:2] == [(100, "response", None), (100, "revisit", 7)]


def test_warc_segments_cross_files_and_losses_show(spark, tmp_dir):
    pages = spark.createDataFrame([(i, "abc" * 5000 + str(i)) for i in range(4)], "page_id long, html string")
    W.write_warc(pages, f"{tmp_dir}/w", segment_bytes=1000, records_per_file=3)
    records = W.read_warc(spark, f"{tmp_dir}/w")
    assert records.where("record_type = 'continuation'").count() > 40
    assert W.reassemble(records).where("complete").count() == 4
    broken = W.reassemble(records.where("segment_number <> 3"))
    assert broken.where("complete").count() == 0
    with pytest.raises(Exception, match="incomplete record"):
        W.payloads(broken).collect()


def test_warc_plain_and_multi_member_files():
    import gzip
    record = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    for data in (record * 2, gzip.compress(record) + gzip.compress(record)):
        assert [b for _, b in W.parse_archive(data)] == [b"abc", b"abc"]
    assert W.http_payload(b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n3;x=1\r\nabc\r\n2\r\nde\r\n0\r\n\r\n") == b"abcde"


# op2
def test_dedup_odd(spark, tmp_dir):
    got = D.exact_dedup(spark, saved(spark, tmp_dir, ODD)).collect()
    assert len(got) == len(ODD) and got[0].size == 99
    seven = [r for r in got if re.sub(r"[\x20\x09-\x0d]+", " ", r.text or "") == "a b c d e f g"]
    assert len(seven) == 3 and sum(r.kept for r in seven) == 1
    assert {(r.keep_id, r.group_size) for r in seven} == {(1, 3)}
    empty = [r for r in got if not r.text]
    assert {(r.keep_id, r.group_size) for r in empty} == {(2, 3)} and sum(r.kept for r in empty) == 1
    assert all(isinstance(r.kept, bool) for r in got)


# op3
def test_mix_odd_and_targets(spark, tmp_dir):
    rows = [(i, "w " * n, None, s) for i, (n, s) in enumerate([(10, "a"), (30, "a"), (5, "b"), (400, "c"), (7, None), (0, "d")])]
    got = X.mix(saved(spark, tmp_dir, rows + ODD)).collect()
    assert len(got) == len(rows) + len(ODD)
    by = collections.defaultdict(list)
    for r in got:
        by[r.source].append(r)
        assert 0 <= r.taken <= 2 * r.size
        assert (r.position is None) == (r.taken == 0) and all(0 <= p < 1 for p in r.positions)
    total = sum(r.size for r in got)
    assert abs(sum(v[0].target for v in by.values()) - 1.5 * total) < 1e-6 * total
    for v in by.values():
        assert abs(sum(r.taken for r in v) - v[0].target) <= 0.5
    order = sorted(by, key=lambda s: (s is None, s))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    level = max(v[0].target / weight[s] for s, v in by.items())
    for s, v in by.items():
        cap = 2 * v[0].source_size
        assert v[0].target == pytest.approx(min(cap, weight[s] * level))


def test_schedule_inverts_its_integral():
    for knots in X.SCHEDULES:
        area = np.trapezoid([w for _, w in knots], [t for t, _ in knots])
        for share in (0.0, 0.1, 0.5, 0.77, 0.999):
            done, t0, w, m = [p for p in X._pieces(knots) if p[0] <= share][-1]
            a = share - done
            t = t0 + 2 * a / (w + np.sqrt(w * w + 2 * m * a))
            at = np.linspace(0, t, 20001)
            assert np.trapezoid(np.interp(at, *zip(*knots)), at) / area == pytest.approx(share, abs=1e-6)


def test_mixed_copies_add_up(spark, documents):
    mixed = X.mix(documents)
    want = mixed.agg(F.sum("taken")).first()[0]
    assert X.mixed_documents(spark, documents, "").agg(F.sum(X.word_count(F.col("text")))).first()[0] == want


# op4
def test_language_held_out_and_odd(spark, documents, tmp_dir):
    got = L.op4_language_id(spark, SF_SMALL).collect()
    lang = {r.doc_id: r.lang for r in documents.select("doc_id", "lang").collect()}
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.9 * len(held)
    odd = L.identify_language(spark, saved(spark, tmp_dir, ODD)).collect()
    assert len(odd) == len(ODD) and all(0 <= r.score <= 1 for r in odd)
    for r in odd:
        assert (r.lang_pred == "und") == (not any(map(str.isalpha, r.text or "")))


def test_language_long_text_is_read_whole(monkeypatch):
    a = np.zeros(1 << L.SPECTRUM_BITS, bool)
    b = a.copy()
    L.mark_spectrum(LONG, a)
    monkeypatch.setattr(L, "_CHUNK", 1000)
    L.mark_spectrum(LONG, b)
    assert (a == b).all()


# op5
def brute_components(rows):
    sets = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append((i, frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])))
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets}


def family(size, words, edits, seed, start=0):
    rng = np.random.default_rng(seed)
    base = [f"t{seed}x{i}" for i in range(words)]
    rows = []
    for k in range(size):
        w = list(base)
        for at in rng.integers(0, words, rng.integers(0, edits + 1)):
            w[at] = f"e{rng.integers(1 << 30)}"
        rows.append((start + k, " ".join(w)))
    return rows


@pytest.mark.parametrize("cell_rows", [J.CELL_ROWS, 4])
def test_join_matches_brute_force(spark, texts, cell_rows):
    rows = list(texts.items()) + family(60, 120, 5, 1, 10_000) + family(40, 60, 4, 2, 20_000) + [
        (30_000, "A b"), (30_001, "a  B"), (30_002, "a b c"), (30_003, None), (30_004, " "), (30_005, LONG), (30_006, LONG + " z z z")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    path = df.withColumn("n", F.lit("clash")).withColumn("row", F.lit("clash"))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.jaccard_join(spark, path, cell_rows=cell_rows)[0].collect()}
    assert got == brute_components(rows)


def brute_links(rows):
    """Linked pairs of rows, by their keys."""
    found = set()
    sets = {i: s for (i, _), s in zip(rows, shingle_sets([t for _, t in rows]))}
    for i, a in sets.items():
        for j, b in sets.items():
            common = len(np.intersect1d(a, b)) if i < j else 0
            if common and 100 * common >= 75 * (len(a) + len(b) - common):
                found.add((i, j))
    return found


def class_of(sets):
    return [(int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True), len(s)) for s in sets]


def links_of(links):
    """The returned links, none twice."""
    got = [((r.a_cls, r.a_n), (r.b_cls, r.b_n)) for r in links.collect()]
    assert len(set(map(frozenset, got))) == len(got)
    return set(map(frozenset, got))


@pytest.mark.parametrize("cell_rows, block", [(J.CELL_ROWS, J.BLOCK_CLASSES), (4, 9)])
def test_join_returns_every_link_of_large_families(spark, monkeypatch, cell_rows, block):
    """Families of more than 16 differing copies, of which some pairs are not alike, and exact copies."""
    monkeypatch.setattr(J, "BLOCK_CLASSES", block)
    rows = family(60, 120, 5, 1) + family(40, 60, 4, 2, 100) + family(25, 200, 2, 3, 200) + family(3, 80, 0, 4, 300) + [(400, None), (401, "one")]
    want = brute_links(rows)
    assert len(want) < 60 * 59 / 2 + 40 * 39 / 2 + 25 * 24 / 2
    out, links = J.jaccard_join(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(5), cell_rows=cell_rows)
    degree = collections.Counter(i for pair in want for i in pair)
    assert {r.doc_id: r.n_links for r in out.collect()} == {i: degree[i] for i, _ in rows}
    cls = dict(zip([i for i, _ in rows], class_of(shingle_sets([t for _, t in rows]))))
    assert links_of(links) == {frozenset((cls[i], cls[j])) for i, j in want if cls[i] != cls[j]}


def test_join_repeated_and_null_keys(spark, tmp_dir):
    got = J.jaccard_join(spark, saved(spark, tmp_dir, ODD))[0].collect()
    assert len(got) == len(ODD)
    by = collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in got)
    assert by[(1, 3, 1)] == 2 and by[(None, 3, 1)] == 1 and by[(2, 0, 2)] == 1 and by[(None, 0, None)] == 1


def test_components_of_a_long_chain(spark):
    edges = spark.range(0, 300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = J.connected_components(spark, edges).collect()
    assert len(got) == 301 and {r.component for r in got} == {0}


# op6
def test_fingerprints(spark, texts, tmp_dir):
    got = {r.doc_id: r for r in M.op6_minhash_fingerprints(spark, SF_SMALL).collect()}
    order = sorted(texts.items())
    for (i, t), (_, n) in zip(order, order[1:] + order[:1]):
        cut = len(t) // 4
        assert got[i].n_chars == len(t)
        assert got[i].edited_sha256 == hashlib.sha256((t[:len(t) - cut] + n[:cut]).encode()).hexdigest()
    same = collections.defaultdict(set)
    for i, t in texts.items():
        same[t].add(got[i].fingerprint)
    assert all(len(v) == 1 for v in same.values())
    saved(spark, tmp_dir, ODD)
    assert M.op6_minhash_fingerprints(spark, tmp_dir).count() == len(ODD)


def test_next_is_the_same_for_any_runs(spark, texts):
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(7)
    want = {r.doc_id: r.next_text for r in M.with_next(df, "doc_id", "text").collect()}
    assert {r.doc_id: r.next_text for r in M.with_next(df, "doc_id", "text", run_rows=9).collect()} == want


def test_likeness_estimates_jaccard():
    rows = [t for _, t in family(30, 300, 12, 5)]
    sig, sets = M.signatures(rows), shingle_sets(rows)
    errors = [M.likeness(sig[k - 1], sig[k]) - len(np.intersect1d(sets[k - 1], sets[k])) / len(np.union1d(sets[k - 1], sets[k])) for k in range(1, 30)]
    assert abs(np.mean(errors)) < 0.06


def test_near_duplicates_are_true_and_found(spark, texts):
    out, links = M.near_duplicates(spark, spark.createDataFrame(list(texts.items()), "doc_id long, text string"))
    got, want = {r.doc_id: r.component_id for r in out.collect()}, brute_components(list(texts.items()))
    assert got.keys() == texts.keys()
    assert all(want[i][1] == want[c][1] for i, c in got.items())
    linked = [i for i, (_, c) in want.items() if c != i]
    assert sum(got[i] == want[i][1] for i in linked) >= 0.99 * len(linked)
    assert all(got[i] == c for i, (_, c) in want.items() if texts[i] == texts[c])


def test_near_duplicates_of_a_band_not_like_its_least(spark):
    """Rows of two families that share bands through common shingles: both families are found whole."""
    rows = family(12, 200, 1, 3) + [(100 + i, t) for i, t in family(12, 200, 1, 4)]
    rows += [(200 + i, f"{rows[0][1]} {rows[12][1]} tail{i}") for i in range(4)]
    want = brute_components(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in M.near_duplicates(spark, df, bands=64)[0].collect()}
    assert got == {i: c for i, (_, c) in want.items()}


def test_near_duplicates_odd_rows(spark):
    got = sorted(((r.doc_id, r.component_id) for r in M.near_duplicates(spark, frame(spark, ODD))[0].collect()), key=str)
    assert len(got) == len(ODD)
    assert dict(x for x in got if x[0] is not None) == {1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 5, 7: 7, 8: 8, 9: 9}
    assert (None, 1) in got and (None, None) in got
    assert M.near_duplicates(spark, frame(spark, []))[0].count() == 0


# op7
def test_shards(spark, texts, tmp_dir):
    for path, rows in ((SF_SMALL, list(texts.items())), (tmp_dir, [(r[0], r[1]) for r in ODD])):
        if path == tmp_dir:
            saved(spark, tmp_dir, ODD)
        got = S.op7_consistent_hash_shards(spark, path).collect()
        loads = collections.Counter(r.shard for r in got)
        counts = [loads[s] for s in range(40)]
        assert len(got) == len(rows) and max(counts) - min(counts) <= 1
        slots = collections.defaultdict(list)
        for r in got:
            slots[r.shard].append(r.slot)
        assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert sorted((r.size, r.text_crc32) for r in got) == sorted((len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for _, t in rows)


def test_bounded_flow_keeps_caps_and_moves_clockwise():
    rng = np.random.default_rng(0)
    _, owner = S.ring(5, 8)
    counts = rng.integers(0, 50, len(owner))
    total = counts.sum()
    caps = total // 5 + (np.arange(5) < total % 5)
    flow = S.bounded_flow(counts, owner, caps)
    ends = flow[1:] + [(None, 0, 0, 0)]
    load, placed = collections.Counter(), 0
    for (arc, rank, shard, slot), (next_arc, next_rank, _, _) in zip(flow, ends):
        n = (next_rank if next_arc == arc else counts[arc]) - rank
        load[shard] += n
        placed += n
    assert placed == total and [load[s] for s in range(5)] == caps.tolist()


# op8, op9
def auc(scores, labels):
    s, y = np.array(scores), np.array(labels)
    pos, neg = s[y == 1], s[y == 0]
    return ((pos[:, None] > neg).mean() + 0.5 * (pos[:, None] == neg).mean())


@pytest.mark.parametrize("query, label, least", [(T.op8_toxicity_gbt, "toxic", 0.8), (Q.op9_quality_gam, "quality", 0.9)])
def test_classifiers_held_out(spark, query, label, least):
    sf = SF_SMALL.replace("0.001", "0.01")
    got = {r.doc_id: r for r in query(spark, sf).collect()}
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [i for i, r in got.items() if r.held_out and i in labels]
    assert auc([got[i].score for i in held], [labels[i] for i in held]) >= least
    assert all(0 <= r.score <= 1 for r in got.values())


@pytest.mark.parametrize("query", [T.op8_toxicity_gbt, Q.op9_quality_gam])
def test_classifiers_odd(spark, query, tmp_dir):
    saved(spark, tmp_dir, ODD)
    spark.createDataFrame([(1, 0, 0), (5, 1, 1), (5, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_dir}/labels.parquet")
    got = query(spark, tmp_dir).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)


def test_toxicity_features_see_disguises_and_second_person():
    lexicon = {"idiot": 1}
    plain, hidden, far = T.features(["you are an idiot", "an 1d10t here", "idiot"], lexicon)
    at = T.FEATURES.index
    assert plain[at("strong")] == 0.25 and plain[at("near_second_person")] > 0
    assert hidden[at("strong")] > 0 and hidden[at("disguised_hits")] > 0 and far[at("near_second_person")] == 0


def test_isotonic_is_monotone():
    rng = np.random.default_rng(1)
    x = rng.random(500)
    y = (rng.random(500) < x).astype(float)
    f = T.Isotonic().fit(x, y, np.ones(500))
    out = f(np.linspace(0, 1, 100))
    assert (np.diff(out) >= 0).all() and abs(out[50] - 0.5) < 0.2


# op10
def brute_best_fit(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [(r, i) for i, r in enumerate(rooms) if r >= n]
        if fits:
            rooms[min(fits)[1]] -= n
        else:
            rooms.append(capacity - n)
    return len(rooms)


@pytest.mark.parametrize("seed", range(5))
def test_best_fit_is_exact(seed):
    rng = np.random.default_rng(seed)
    lengths = np.concatenate([rng.integers(1, 101, 300), np.full(50, 33), rng.integers(1, 8, 200)])
    counts = {int(k): int(v) for k, v in collections.Counter(lengths.tolist()).items()}
    plan = sorted(P.best_fit_decreasing(counts, 100))
    used = collections.defaultdict(list)
    for k, (n, rank, first, offset) in enumerate(plan):
        end = plan[k + 1][1] if k + 1 < len(plan) and plan[k + 1][0] == n else counts[n]
        for r in range(rank, end):
            used[first + r - rank].append((offset, n))
    for v in used.values():
        v.sort()
        assert v[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(v, v[1:])) and sum(n for _, n in v) <= 100
    assert sum(map(len, used.values())) == len(lengths) and len(used) == brute_best_fit(lengths, 100)


def test_packing_ids_are_those_of_whole_texts(spark, texts, tmp_dir):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(P.default_tokenizer())
    saved(spark, tmp_dir, ODD)
    for path, rows in ((SF_SMALL, list(texts.items())), (tmp_dir, [(r[0], r[1]) for r in ODD])):
        got = P.op10_best_fit_packing(spark, path).collect()
        want = collections.Counter()
        for i, t in rows:
            ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
            for p, s in enumerate(range(0, len(ids), 2048)):
                want[(i, p, s, len(ids[s:s + 2048]), zlib.crc32(ids[s:s + 2048].tobytes()))] += 1
        assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
        places = collections.defaultdict(list)
        for r in got:
            places[r.sequence_id].append((r.offset, r.length))
        for v in places.values():
            v.sort()
            assert v[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(v, v[1:])) and v[-1][0] + v[-1][1] <= 2048


# all
def test_empty_tables(spark, tmp_dir):
    frame(spark, []).write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_dir}/labels.parquet")
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{tmp_dir}/pages.parquet")
    import corpus_pipeline

    from quarry.llm.catalog import QUERIES
    for name, query in (QUERIES | {"pipeline": corpus_pipeline.run}).items():
        assert query(spark, tmp_dir).count() == 0, name


def test_word_cache_that_forgets_gives_the_same_ids(monkeypatch):
    import pyarrow as pa
    words = [f"w{i % 97}x{i % 89} plain Mixed, {i % 7}" for i in range(400)]
    batches = [pa.array(words[i: i + 20]) for i in range(0, 400, 20)]
    roomy = P.WordIds(P.default_tokenizer())
    want = [roomy.encode(b) for b in batches]
    monkeypatch.setattr(P, "CACHED_WORDS", 40)
    tight = P.WordIds(P.default_tokenizer())
    for b, (flat, at) in zip(batches, want):
        ids, starts = tight.encode(b)
        assert ids.tolist() == flat.tolist() and starts.tolist() == at.tolist()
        assert len(tight.place) <= 40 + 84
