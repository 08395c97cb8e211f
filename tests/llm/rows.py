"""Documents with everything that may go wrong in a row, and helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "One long text goes on and on, word after word. " * 4000
PROSE = "The cat sat on the mat and looked at the old dog, which slept near the warm stove all day long."
ROWS = [
    (1, None, "en", "a", None),
    (2, "", "en", "a", 0),
    (3, " \t\n\x0b\x0c\r ", None, "a", 7),
    (4, LONG, "en", None, len(LONG)),
    (5, PROSE, "en", "a", 1),
    (5, PROSE, "en", "a", 1),
    (5, "Another text under the same id, with quite a few words in it to count.", "en", "b", 1),
    (6, PROSE, None, None, None),
    (None, "A text without any id at all, but with some words of its own.", "en", "b", 3),
    (7, "%%% ### 12345 !!!", "en", "a", 3),
    (8, "naïve café 日本語 🙂 x́ <|endoftext|> İstanbul", "fr", "b", 3),
    (-9, "word " * 300, "en", "a", 3),
    (10, "Same line\nSame line\nSame line\n\n\nother", "en", "a", 3),
]
#: Names that operators might use themselves.
CLASHES = ["key", "row", "bin", "node", "slot", "n_words", "d", "h", "score", "keys", "at", "part", "before", "start", "length", "place", "kept", "predicted", "symbols_high", "counts", "root"]


def edges(spark: SparkSession) -> DataFrame:
    """The rows of ROWS in three partitions, with columns that clash."""
    frame = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    return frame.withColumns({c: F.lit(f"clash {c}") for c in CLASHES})


def nothing(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def text_of(row) -> str:
    return row["text"] or ""
