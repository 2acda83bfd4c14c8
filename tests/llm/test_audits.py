"""Source divergence, spelling variants and SimHash near-dedup against brute force."""

import collections
import re
import zlib

import numpy as np
import pytest
import xxhash
from conftest import SF_SMALL
from test_operators import ODD, frame, saved

from quarry.llm import divergence as V
from quarry.llm import simhash as H
from quarry.llm import spelling as G


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


# op11
def brute_divergence(rows, kept_docs):
    """The contract's sums, term by term; rows are (lang, source, text)."""
    counts, docs, groups = collections.Counter(), collections.Counter(), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        found = collections.Counter(re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(text or "")))
        for term, n in found.items():
            counts[lang, source, term] += n
            docs[lang, term] += 1
    out = []
    for lang, source in groups:
        kept = [t for (x, t), n in docs.items() if x == lang and n >= kept_docs]
        sources = sorted(s for x, s in groups if x == lang)

        def shares(some):
            total = sum(counts[lang, s, t] for s in some for t in kept)
            return {t: 1 + 10**9 * (sum(counts[lang, s, t] for s in some) + 5) // (total + 5 * len(kept)) for t in kept}
        p, q = shares([source]), shares(sources)
        pairs = []
        for other in sources:
            if other != source:
                r = shares([other])
                pairs.append((other, sum(abs(p[t] - r[t]) for t in kept)))
        terms = [(t, p[t] - q[t]) for t in kept if counts[lang, source, t] and p[t] > q[t]]
        for part, items, most in (("pair", pairs, None), ("term", terms, 50)):
            for rank, (item, value) in enumerate(sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most], 1):
                out.append((lang, source, part, item, value, rank))
    return sorted(out)


def test_divergence_oracle(spark):
    from oracle_check import compare, duck

    from quarry.llm.catalog import ORACLE, QUERIES
    r = compare(spark, duck(SF_SMALL), "op11", QUERIES["op11_source_divergence"], ORACLE["op11_source_divergence"], SF_SMALL)
    assert r["ok"], r


@pytest.mark.parametrize("kept_docs", [1, 2])
def test_divergence_brute_force(spark, kept_docs, monkeypatch):
    rng = np.random.default_rng(5)
    names = ["a", "Bb", "é", "z9z", "tail", "日本"]
    rows = [(i, " ".join(rng.choice(names, 6)), str(rng.choice(["en", "fr"])), "s" + "0" * int(rng.integers(4))) for i in range(60)] + ODD
    rows += [(200, "", "xx", "lone"), (201, "12 34", "yy", "u"), (202, None, "yy", "v")]
    monkeypatch.setattr(V, "HELD_ENTRIES", 3)
    got = V.source_divergence(spark, frame(spark, rows).repartition(3), kept_docs=kept_docs).collect()
    assert sorted(tuple(r) for r in got) == brute_divergence([(r[2], r[3], r[1]) for r in rows], kept_docs)
    assert V.source_divergence(spark, frame(spark, rows).limit(0)).collect() == []


def test_tree_corrects_once_per_node_and_ancestor():
    rows = sorted([([0, 1, 2], [9, 7, 5]), ([0, 1, 2], [9, 7, 6]), ([0, 1], [9, 7]), ([1, 2], [8, 8]), ([0, 2], [9, 3])])
    tree, want = V.PatternTree(), collections.Counter()
    for s, p in rows:
        tree.insert(np.array(s), np.array(p), np.array([2, 4, 1])[s], 3)
        for j in range(len(s)):
            for i in range(j):
                p1, p2, z1, z2 = p[i], p[j], [2, 4, 1][s[i]], [2, 4, 1][s[j]]
                want[s[i], s[j]] += 3 * (abs(p1 - p2) - abs(p1 - z2) - abs(z1 - p2) + abs(z1 - z2))
    tree._close(0)
    out = tree.corrections()
    assert {(a, b): v for a, b, v in zip(out.a, out.b, out.value)} == {k: v for k, v in want.items() if v}
    # paths 0-1-2, 0-1-2', 0-1, 0-2, 1-2 have nodes 0, 01, 012, 012', 02, 1, 12
    assert tree.combinations == 1 + 2 + 2 + 1 + 1


# op12
def brute_words(rows):
    counts = collections.Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(words):
    near = {w: [v for v in words if abs(len(v) - len(w)) <= 1 and one_edit(v, w)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 2 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out, key=lambda r: r[0])


def variants(df):
    return sorted([(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()], key=lambda r: r[0])


def test_spelling_of_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    want = brute_variants(brute_words([(r.doc_id, r.text) for r in docs.collect()]))
    assert variants(G.op12_spelling_variants(spark, SF_SMALL)) == want
    assert any(r[1] for r in want)


def made_up_words(n=700):
    """Anagrams, repeated letters and chains of edits."""
    rng = np.random.default_rng(11)
    words = {"".join(rng.choice(list("abé"), int(rng.integers(4, 9)))) for _ in range(n)}
    words |= {"abcde", "abcdef", "abcdeff", "abcdefff", "ÀÿÀÿÀ", "ÀÿÀÿÀÀ", "x" * 70, "x" * 71, "x" * 300, "x" * 299 + "y"}
    return sorted(words), rng


def test_spelling_brute_force_in_small_cells(spark, monkeypatch):
    words, rng = made_up_words()
    rows = [(i, " ".join(rng.choice(words, 60)) + " " + " ".join([words[i % len(words)].upper()] * int(rng.integers(1, 9))), "en", "s") for i in range(400)] + ODD
    want = brute_variants(brute_words([(r[0], r[1]) for r in rows]))
    docs = frame(spark, rows).repartition(3)
    monkeypatch.setattr(G, "HELD_WORDS", 50)
    assert variants(G.spelling_variants(spark, docs)) == want
    assert variants(G.spelling_variants(spark, docs, cell_words=20, block=15)) == want
    assert variants(G.spelling_variants(spark, docs.limit(0))) == []


def test_tree_reaches_all_that_one_edit_can(monkeypatch):
    words = [w.encode("latin-1") for w in made_up_words()[0] if len(w) >= 5]
    for size in (5, 6, 7, 8):
        homes = [w for w in words if len(w) == size]
        for shorter in (0, 1):
            queries = [w for w in words if len(w) == size - shorter]
            got = list(G.near_pairs(queries, homes))
            assert len(set(got)) == len(got)
            assert sorted(got) == [(i, j) for i, a in enumerate(queries) for j, b in enumerate(homes) if one_edit(a, b)]


def test_roots_of_a_long_path(spark):
    rows = [(f"w{i}", f"w{i + 1}") for i in range(11)] + [("v", "w3")]
    got = G.roots(spark, spark.createDataFrame(rows, "word string, form string")).collect()
    assert {(r.word, r.root) for r in got} == {(w, "w11") for w, _ in rows}


# op13
def brute_mark(text):
    words = [w for w in re.split(r"[\x20\x09-\x0d]+", lower(text or "")) if w]
    shingles = [" ".join(words[i: i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(marks):
    """Component (least id) of each (id, mark)."""
    classes = sorted({m for _, m in marks})
    root = {m: m for m in classes}

    def find(m):
        while root[m] != m:
            m = root[m]
        return m
    for i, a in enumerate(classes):
        for b in classes[i + 1:]:
            if (a ^ b).bit_count() <= 3:
                root[find(a)] = find(b)
    least = {}
    for k, m in marks:
        if k is not None:
            least[find(m)] = min(k, least.get(find(m), k))
    return sorted(((k, f"{m:016x}", least.get(find(m))) for k, m in marks), key=str)


def test_simhash_of_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    got = sorted((tuple(r) for r in H.op13_simhash_near_dedup(spark, SF_SMALL).collect()), key=str)
    assert got == brute_groups([(r.doc_id, brute_mark(r.text)) for r in docs])


def test_simhash_odd_rows_and_chunks(spark, tmp_dir, monkeypatch):
    want = brute_groups([(r[0], brute_mark(r[1])) for r in ODD])
    saved(spark, tmp_dir, ODD)
    assert sorted((tuple(r) for r in H.op13_simhash_near_dedup(spark, tmp_dir).collect()), key=str) == want
    monkeypatch.setattr(H, "_CHUNK_BYTES", 7)
    monkeypatch.setattr(H, "_CHUNK_SHINGLES", 4)
    for _, text, *_ in ODD:
        if len(text or "") < 1000:
            assert H.fingerprint((text or "").encode()) == brute_mark(text)
    assert H.simhash_groups(spark, frame(spark, ODD).limit(0)).collect() == []


def family(seed=3):
    """Fingerprints in dense clouds, chains of three bits, and alone."""
    rng = np.random.default_rng(seed)
    out = {0, (1 << 64) - 1}
    for _ in range(40):
        x = int(rng.integers(0, 1 << 63)) * 2 + 1
        for _ in range(int(rng.integers(1, 30))):
            out.add(x)
            for b in rng.integers(0, 64, int(rng.integers(1, 5))):
                x ^= 1 << int(b)
    return sorted(out)


@pytest.mark.parametrize("long_list", [1024, 17])
def test_simhash_links_connect_what_brute_force_connects(spark, monkeypatch, long_list):
    from quarry.llm.ngram_join import connected_components
    marks = family()
    cloud = sorted({0x5A5A << 40 | (1 << a) | (1 << b) for a in range(24) for b in range(24)})
    marks = sorted(set(marks) | set(cloud))
    signed = [(m - (1 << 64) if m >= 1 << 63 else m,) for m in marks]
    monkeypatch.setattr(H, "LONG_LIST", long_list)
    links = H.simhash_links(spark, spark.createDataFrame(signed, "mark long").repartition(4))
    assert all(((a - b) % (1 << 64) or 1) and ((a ^ b) & ((1 << 64) - 1)) for a, b in links.collect())
    found = {r.node: r.component for r in connected_components(spark, links).collect()}
    got = collections.defaultdict(set)
    for (s,), m in zip(signed, marks):
        got[found.get(s, s)].add(m)
    want = collections.defaultdict(set)
    for m, _, c in brute_groups([(m, m) for m in marks]):
        want[c].add(m)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_probe_equals_tally():
    rng = np.random.default_rng(1)
    free = (1, 4, 6)
    marks = np.unique(sum((rng.integers(0, 16, 900).astype(np.uint64) * np.uint64(9)) << np.uint64(8 * p) for p in free) | np.uint64(7))
    a, b = H._groups_by_probe(marks, free), H._groups_by_tally(marks)
    assert (a == b).all() and 1 < len(set(a)) < len(marks)
