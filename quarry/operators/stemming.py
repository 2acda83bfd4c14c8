"""English stemming analyzer (T2): default tokens without stop words, as Porter stems.

It is an ordinary ``Analyzer`` (``Column -> Column``), so ``match``, ``bool_query``,
``with_token_field`` and ``ranked_page`` take it. Tokens, stop words and stems are JVM expressions;
a search stems only the tokens that begin like the stems it looks for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.analysis import analyze_literal, text_tokens
from quarry.functions.predicates import match
from quarry.functions.stem import porter_stem, stem_tokens


def english_stop_words() -> list[str]:
    """Spark's built-in English stop-word list."""
    return StopWordsRemover.loadDefaultStopWords("english")


class EnglishAnalyzer:
    """Stems of the tokens that are not stop words; null stays null.

    ``stop_words`` is a parameter, for columns and query text alike.
    """

    def __init__(self, stop_words: Sequence[str] | None = None):
        self.stop_words = stop_words

    def _kept(self, c: Column | str) -> Column:
        stops = english_stop_words() if self.stop_words is None else list(self.stop_words)
        return F.filter(text_tokens(c), lambda t: ~t.isin(stops)) if stops else text_tokens(c)

    def __call__(self, c: Column | str) -> Column:
        return stem_tokens(self._kept(c))

    def restricted(self, c: Column | str, stems: Sequence[str]) -> Column:
        """The stems of those tokens only that may have one of ``stems``."""
        starts = [self.common_part(x) for x in dict.fromkeys(stems)]
        return stem_tokens(F.filter(self._kept(c), lambda t: F.exists(F.array(*[F.lit(x) for x in starts]).cast("array<string>"), t.startswith)))

    def query_tokens(self, text: str) -> list[str]:
        """The analyzed query text, known when the plan is made."""
        return [porter_stem(t) for t in analyze_literal(SparkSession.getActiveSession(), text, self._kept)]

    @staticmethod
    def common_part(token: str) -> str:
        """What every word with this stem begins with: the rules change a stem's last letter at most, to i, e or l."""
        return token[:-1] if token[-1:] in ("i", "e", "l") else token


english_analyzer = EnglishAnalyzer()


def stemmed_match(docs: DataFrame, id_col: str, text_col: str, word: str,
                  stop_words: list[str] | None = None) -> DataFrame:
    """Ids of documents with a token whose stem is among the stems of ``word``."""
    return docs.where(match(text_col, word, EnglishAnalyzer(stop_words))).select(id_col).distinct()
