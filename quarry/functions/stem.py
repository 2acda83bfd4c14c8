"""English stemming (T2): the Porter (1980) suffix-stripping algorithm.

``stem_tokens`` stems a whole array column with Column expressions, so no token leaves the JVM.
``porter_stem`` is the same for one word, for query text.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

_VOWELS = frozenset("aeiou")

# Suffix rules of steps 2, 3 and 4 of the published algorithm,
# as (suffix, replacement). Only the longest matching suffix of a step is tried.
STEP2_RULES = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"),
    ("izer", "ize"), ("abli", "able"), ("alli", "al"), ("entli", "ent"),
    ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"),
    ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"),
    ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
]
STEP3_RULES = [
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"),
    ("ical", "ic"), ("ful", ""), ("ness", ""),
]
STEP4_SUFFIXES = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment",
    "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
]


def _is_cons(w: str, i: int) -> bool:
    ch = w[i]
    if ch in _VOWELS:
        return False
    if ch == "y":
        return i == 0 or not _is_cons(w, i - 1)
    return True


def _measure(stem: str) -> int:
    """m in [C](VC)^m[V]."""
    n, i, size = 0, 0, len(stem)
    while i < size and _is_cons(stem, i):
        i += 1
    while i < size:
        while i < size and not _is_cons(stem, i):
            i += 1
        if i >= size:
            break
        while i < size and _is_cons(stem, i):
            i += 1
        n += 1
    return n


def _has_vowel(stem: str) -> bool:
    return any(not _is_cons(stem, i) for i in range(len(stem)))


def _double_cons(w: str) -> bool:
    return len(w) >= 2 and w[-1] == w[-2] and _is_cons(w, len(w) - 1)


def _cvc(w: str) -> bool:
    return (len(w) >= 3 and _is_cons(w, len(w) - 3) and not _is_cons(w, len(w) - 2)
            and _is_cons(w, len(w) - 1) and w[-1] not in "wxy")


def _longest(word: str, suffixes):
    best = None
    for s in suffixes:
        key = s[0] if isinstance(s, tuple) else s
        if word.endswith(key) and (best is None or len(key) > len(best[0] if isinstance(best, tuple) else best)):
            best = s
    return best


def _step1ab(w: str) -> str:
    if w.endswith("sses"):
        w = w[:-2]
    elif w.endswith("ies"):
        w = w[:-2]
    elif w.endswith("ss"):
        pass
    elif w.endswith("s"):
        w = w[:-1]

    if w.endswith("eed"):
        if _measure(w[:-3]) > 0:
            w = w[:-1]
        return w
    for suf in ("ed", "ing"):
        if w.endswith(suf):
            stem = w[: -len(suf)]
            if not _has_vowel(stem):
                return w
            w = stem
            if w.endswith(("at", "bl", "iz")):
                return w + "e"
            if _double_cons(w) and w[-1] not in "lsz":
                return w[:-1]
            if _measure(w) == 1 and _cvc(w):
                return w + "e"
            return w
    return w


def _step1c(w: str) -> str:
    if w.endswith("y") and _has_vowel(w[:-1]):
        return w[:-1] + "i"
    return w


def _replace_step(w: str, rules, min_m: int) -> str:
    rule = _longest(w, rules)
    if rule is None:
        return w
    suf, rep = rule
    stem = w[: -len(suf)]
    return stem + rep if _measure(stem) > min_m - 1 else w


def _step4(w: str) -> str:
    suf = _longest(w, STEP4_SUFFIXES)
    if suf is None:
        return w
    stem = w[: -len(suf)]
    if _measure(stem) <= 1:
        return w
    if suf == "ion" and not stem.endswith(("s", "t")):
        return w
    return stem


def _step5(w: str) -> str:
    if w.endswith("e"):
        stem = w[:-1]
        m = _measure(stem)
        if m > 1 or (m == 1 and not _cvc(stem)):
            w = stem
    if w.endswith("ll") and _measure(w) > 1:
        w = w[:-1]
    return w


@lru_cache(maxsize=1 << 16)
def porter_stem(word: str) -> str:
    """Stem one lower-case word; words of one or two letters are returned as is."""
    if word is None or len(word) <= 2:
        return word
    w = _step1ab(word)
    w = _step1c(w)
    w = _replace_step(w, STEP2_RULES, 1)
    w = _replace_step(w, STEP3_RULES, 1)
    w = _step4(w)
    return _step5(w)


# The same rules on columns. In a word whose leading y is written Y, a vowel group is one of
# aeiouy and any of aeiou after it, and a consonant group one of the rest and any of the rest but y after it.
_CONSONANTS, _VOWEL_GROUP = "[^aeiou][^aeiouy]*", "[aeiouy][aeiou]*"
_START = f"^(?:{_CONSONANTS})?{_VOWEL_GROUP}{_CONSONANTS}"
_MEASURE_1_UP = _START
_MEASURE_2_UP = _START + _VOWEL_GROUP + _CONSONANTS
_MEASURE_1 = f"{_START}(?:{_VOWEL_GROUP})?$"
_WITH_VOWEL = f"^(?:{_CONSONANTS})?[aeiouy]"
_SHORT_END = f"^{_CONSONANTS}[aeiouy][^aeiouwxy]$"
_DOUBLE_END = r"(?:([^aeiouylsz])\1|(?:^|[^aeiouy])(?:yy)+|[aeiou]y(?:yy)+)$"


def _less(w: Column, letters: int) -> Column:
    return F.substring(w, F.lit(1), F.length(w) - letters)


def _plural(w: Column) -> Column:
    return F.when(w.rlike("(?:ss|i)es$"), _less(w, 2)).when(w.rlike("[^s]s$"), _less(w, 1)).otherwise(w)


def _past(w: Column) -> Column:
    """Words that lose -ed or -ing are marked with a final ``*`` for the repair that follows."""
    stem = F.regexp_replace(w, "(?:ed|ing)$", "")
    return (F.when(w.endswith("eed"), F.when(_less(w, 3).rlike(_MEASURE_1_UP), _less(w, 1)).otherwise(w))
            .when(w.rlike("(?:ed|ing)$") & stem.rlike(_WITH_VOWEL), F.concat(stem, F.lit("*"))).otherwise(w))


def _repaired(w: Column) -> Column:
    stem = _less(w, 1)
    return (F.when(~w.endswith("*"), w).when(stem.rlike("(?:at|bl|iz)$"), F.concat(stem, F.lit("e")))
            .when(stem.rlike(_DOUBLE_END), _less(w, 2)).when(stem.rlike(_MEASURE_1) & stem.rlike(_SHORT_END), F.concat(stem, F.lit("e")))
            .otherwise(stem))


def _final_y(w: Column) -> Column:
    return F.when(w.endswith("y") & _less(w, 1).rlike(_WITH_VOWEL), F.concat(_less(w, 1), F.lit("i"))).otherwise(w)


def _suffix(w: Column, rules, condition: str) -> Column:
    """Replace the longest suffix among ``rules`` if what stands before it meets ``condition``."""
    found = f"^(.*?)({'|'.join(s for s, _ in rules)})$"
    ends = F.regexp_extract(w, found, 2)
    stem = F.regexp_extract(w, found, 1)
    to = F.create_map(*[F.lit(x) for rule in rules for x in rule])
    return F.when((ends != "") & stem.rlike(condition), F.concat(stem, to[ends])).otherwise(w)


def _ending(w: Column) -> Column:
    found = f"^(.*?)({'|'.join(STEP4_SUFFIXES)})$"
    stem, ends = F.regexp_extract(w, found, 1), F.regexp_extract(w, found, 2)
    return F.when((ends != "") & stem.rlike(_MEASURE_2_UP) & ((ends != "ion") | stem.rlike("[st]$")), stem).otherwise(w)


def _final_e(w: Column) -> Column:
    stem = _less(w, 1)
    return F.when(w.endswith("e") & (stem.rlike(_MEASURE_2_UP) | (stem.rlike(_MEASURE_1) & ~stem.rlike(_SHORT_END))), stem).otherwise(w)


def _final_l(w: Column) -> Column:
    return F.when(w.endswith("ll") & w.rlike(_MEASURE_2_UP), _less(w, 1)).otherwise(w)


def stem_tokens(tokens: Column) -> Column:
    """The stems of an array of lower-case words, in order; words of one or two letters stay.

    Each step is a ``transform`` of its own, so that a step's result is made once and not
    once for every place that the next step uses it in.
    """
    steps = [_plural, _past, _repaired, _final_y, lambda w: _suffix(w, STEP2_RULES, _MEASURE_1_UP),
             lambda w: _suffix(w, STEP3_RULES, _MEASURE_1_UP), _ending, _final_e, _final_l]

    def all_steps(words: Column) -> Column:
        out = F.transform(words, lambda w: F.regexp_replace(w, "^y", "Y"))
        for step in steps:
            out = F.transform(out, step)
        return F.zip_with(words, out, lambda w, stem: F.when(F.length(w) <= 2, w).otherwise(F.regexp_replace(stem, "^Y", "y")))

    return F.transform(F.array(tokens), all_steps)[0]
