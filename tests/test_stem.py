import pytest

from quarry.functions.stem import porter_stem

# full-algorithm results for words from the published description
PAIRS = {
    "caresses": "caress", "ponies": "poni", "ties": "ti", "caress": "caress", "cats": "cat",
    "feed": "feed", "agreed": "agre", "plastered": "plaster", "bled": "bled", "motoring": "motor",
    "sing": "sing", "conflated": "conflat", "troubled": "troubl", "sized": "size", "hopping": "hop",
    "tanned": "tan", "falling": "fall", "hissing": "hiss", "fizzed": "fizz", "failing": "fail",
    "filing": "file", "happy": "happi", "sky": "sky", "relational": "relat",
    "conditional": "condit", "rational": "ration", "digitizer": "digit", "operator": "oper",
    "feudalism": "feudal", "hopefulness": "hope", "goodness": "good", "revival": "reviv",
    "allowance": "allow", "inference": "infer", "airliner": "airlin", "adjustable": "adjust",
    "replacement": "replac", "adjustment": "adjust", "dependent": "depend", "adoption": "adopt",
    "communism": "commun", "activate": "activ", "effective": "effect", "probate": "probat",
    "rate": "rate", "cease": "ceas", "controll": "control", "roll": "roll",
    "generalizations": "gener", "oscillators": "oscil", "a": "a", "is": "is",
}


@pytest.mark.parametrize("word,stem", sorted(PAIRS.items()))
def test_porter_pairs(word, stem):
    assert porter_stem(word) == stem


def test_stemmed_match_matches_brute_force(spark):
    import duckdb
    from pyspark.sql import functions as F
    from quarry.operators.stemming import english_stop_words, stemmed_match
    from conftest import SF_SMALL
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where(F.col("lang") == "en")
    got = sorted(r.doc_id for r in stemmed_match(docs, "doc_id", "text", "ating").collect())
    stops = set(english_stop_words())
    rows = duckdb.sql(
        f"SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+'), "
        f"lambda x: x <> '') FROM '{SF_SMALL}/documents.parquet' WHERE lang = 'en'").fetchall()
    want = sorted(d for d, toks in rows
                  if any(t not in stops and porter_stem(t) == "at" for t in toks or []))
    assert got == want and len(want) > 0


def test_column_stemmer_equals_the_word_stemmer(spark):
    """On the vocabulary of all documents, and on words made of every suffix after every kind of stem."""
    from pyspark.sql import functions as F
    from quarry.functions.analysis import text_tokens
    from quarry.functions.stem import STEP2_RULES, STEP3_RULES, STEP4_SUFFIXES, stem_tokens
    from quarry.operators.stemming import EnglishAnalyzer
    from conftest import SF_SMALL
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    words = {r.w for r in docs.select(F.explode(text_tokens("text")).alias("w")).distinct().collect()}
    stems = ["", "a", "s", "tr", "trac", "hop", "fall", "hiss", "yell", "say", "boy", "by", "ayt", "relat", "oscill", "syzyg", "élan", "be", "agre", "fil", "x", "aed"]
    ends = [s for s, _ in STEP2_RULES + STEP3_RULES] + STEP4_SUFFIXES + ["s", "es", "ies", "sses", "ed", "eed", "ing", "y", "e", "ll", "ated", "bled", "izing", "ned", "lled", "yy", ""]
    words |= {a + b for a in stems for b in ends} | {a + b + c for a in stems for b in ends for c in ("s", "ed", "ing", "ly")} | set(PAIRS)
    words = sorted(w for w in words if w)
    df = spark.createDataFrame([(words[i: i + 50],) for i in range(0, len(words), 50)], "w array<string>")
    got = {w: s for r in df.select("w", stem_tokens(F.col("w")).alias("s")).collect() for w, s in zip(r.w, r.s)}
    wrong = {w: (s, porter_stem(w)) for w, s in got.items() if s != porter_stem(w)}
    assert len(got) == len(words) and not wrong, list(wrong.items())[:20]
    for w in words:  # what a search tests before it stems
        assert w.startswith(EnglishAnalyzer.common_part(porter_stem(w))), w


def test_no_python_worker_stems(spark):
    from quarry.operators.stemming import stemmed_match
    df = spark.createDataFrame([(1, "hoping for hopes"), (2, "hop on"), (3, None), (4, "the")], "id int, t string")
    out = stemmed_match(df, "id", "t", "hoped")
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    assert [r.id for r in out.collect()] == [1]
    assert stemmed_match(df, "id", "t", "the").collect() == []  # a stop word finds nothing
