"""Quality rules whose thresholds follow the data of each language and source.

Every text is counted once: words, symbols, repeated lines and words, capitals. The ratios of texts that
pass the fixed base rules go into quantile sketches, one for each language, source and ratio. A sketch
is a table of counts by bucket with a relative error of 1/32; sketches merge by adding counts, so those of
sources merge to a language's and those to the whole corpus'. A group with too few texts takes the
thresholds of its language, and a language with too few those of the corpus. A threshold lies beyond a quantile
of the group by a multiple of the group's own spread, and a small floor further, so that groups without any spread
don't lose texts by rounding: beyond the upper quartile by three interquartile ranges where a share of the texts is
expected to be junk, and beyond the last hundredth by half of its distance from the quartile where
tails are long. Texts are then joined with the thresholds of their group and filtered.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duelframe.llm.common import stored, texts_of

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: Texts that a group needs for thresholds of its own.
MIN_GROUP = 200
#: Ratio: (numerator, denominator, scale, anchor, inner, halves, floor, whether there is a lower threshold too). The upper threshold is
#: the anchor's quantile, plus `halves` halves of its distance from the inner one, plus the floor; the lower one mirrors it.
RATIOS = {
    "symbols": ("n_symbols", "n_words", 1000, 75, 25, 6, 20, False),
    "repeats": ("n_repeat_words", "n_words", 1000, 99, 75, 1, 10, False),
    "dup_lines": ("n_dup_lines", "n_words", 1000, 99, 75, 1, 2, False),
    "capitals": ("n_capitals", "word_chars", 1000, 99, 75, 1, 5, False),
    "word_length": ("word_chars", "n_words", 100, 99, 75, 1, 10, True),
}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_capitals"]
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
WINDOW = 5
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of five that occurs twice or more, the first one included."""
    n = len(words)
    if n <= WINDOW:
        return 0
    each = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
    windows = sum(each[i : n - WINDOW + 1 + i] * f for i, f in enumerate(_FACTORS))
    ordered = np.sort(windows)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    starts = np.flatnonzero(np.isin(windows, twice))
    marks = np.zeros(n + 1, dtype=np.int64)
    marks[starts] += 1
    np.subtract.at(marks, starts + WINDOW, 1)
    return int((np.cumsum(marks)[:n] > 0).sum())


def count_text(text: str) -> tuple[int, ...]:
    """The numbers of COUNTS, over the whole text. Words are what ASCII white space parts."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(raw) - len(raw.translate(None, CAPITALS)),
    )


def counts_of(texts: pd.Series) -> pd.DataFrame:
    """The numbers of COUNTS of each text; a null text has no words."""
    return pd.DataFrame([count_text(x) for x in texts_of(texts)], columns=COUNTS, dtype="int64")


def text_counts(documents: DataFrame, *more: Column) -> DataFrame:
    """doc_id, lang, source, the numbers of COUNTS of each document, and the columns of `more`."""
    rows = documents.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), F.pandas_udf(counts_of, ", ".join(f"{c} long" for c in COUNTS))("text").alias("counts"), *more)
    return rows.select("*", "counts.*").drop("counts")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def ratio(name: str) -> Column:
    top, below, scale = RATIOS[name][:3]
    return F.floor(scale * F.col(top) / F.greatest(F.col(below), F.lit(1))).cast("long")


def width(value: Column) -> Column:
    """Numbers in the value's bucket: one below 64, else as many as share its six leading bits."""
    return F.pow(F.lit(2), F.greatest(F.length(F.bin(value)) - 6, F.lit(0))).cast("long")


def bucket(value: Column) -> Column:
    """Lower edge of the value's bucket."""
    return (F.floor(value / width(value)) * width(value)).cast("long")


def sketches(counts: DataFrame) -> DataFrame:
    """lang, source, ratio, edge, n: a sketch of every ratio for each language and source, base rules passed."""
    each = F.inline(F.array(*[F.struct(F.lit(name).alias("ratio"), bucket(ratio(name)).alias("edge")) for name in RATIOS]))
    return counts.where(~base_failed()).select("lang", "source", each).groupBy("lang", "source", "ratio", "edge").agg(F.count(F.lit(1)).alias("n"))


def merge(sketch: DataFrame, *groups: str) -> DataFrame:
    """Sketches of coarser groups: counts add up."""
    return sketch.groupBy(*groups, "ratio", "edge").agg(F.sum("n").alias("n"))


def limits(sketch: DataFrame, *groups: str) -> DataFrame:
    """A row per group: texts, and low and high threshold of each ratio."""
    order = Window.partitionBy(*groups, "ratio")
    placed = sketch.withColumn("upto", F.sum("n").over(order.orderBy("edge"))).withColumn("total", F.sum("n").over(order))
    quantile = lambda p: F.min(F.when(100 * F.col("upto") >= p * F.col("total"), F.col("edge"))).alias(f"q{p}")
    found = placed.groupBy(*groups, "ratio").agg(F.max("total").alias("total"), *[quantile(p) for p in (1, 25, 75, 99)])
    columns = [F.max("total").alias("total")]
    for name, (_, _, _, anchor, inner, halves, floor, lower) in RATIOS.items():
        here = F.col("ratio") == name
        for side, sign, p, q in (("high", 1, anchor, inner), ("low", -1, 100 - anchor, 100 - inner)):
            if side == "high" or lower:
                reach = F.floor(halves * F.abs(F.col(f"q{p}") - F.col(f"q{q}")) / 2) + floor
                reach = reach + width(F.col(f"q{p}")) - 1 if side == "high" else reach  # from the bucket's upper edge
                columns.append(F.max(F.when(here, F.col(f"q{p}") + sign * reach)).alias(f"{name}_{side}"))
    return found.groupBy(*groups).agg(*columns)


def thresholds(counts: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """Thresholds for every language and source that occurs, from the finest group with enough texts."""
    names = [f"{n}_high" for n in RATIOS] + [f"{n}_low" for n, r in RATIOS.items() if r[-1]]
    fine = stored(sketches(counts), "sketches")
    whole = limits(merge(fine).withColumn("all", F.lit(1)), "all").first()  # one row
    own = limits(fine, "lang", "source").select(F.col("lang").alias("l0"), F.col("source").alias("s0"), F.col("total").alias("t0"), *[F.col(n).alias(f"{n}_0") for n in names])
    by_lang = limits(merge(fine, "lang"), "lang").select(F.col("lang").alias("l1"), F.col("total").alias("t1"), *[F.col(n).alias(f"{n}_1") for n in names])
    groups = counts.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("texts"))
    joined = groups.join(own, groups["lang"].eqNullSafe(F.col("l0")) & groups["source"].eqNullSafe(F.col("s0")), "left")
    joined = joined.join(by_lang, joined["lang"].eqNullSafe(F.col("l1")), "left")
    pick = lambda n: F.when(F.col("t0") >= min_group, F.col(f"{n}_0")).when(F.col("t1") >= min_group, F.col(f"{n}_1")).otherwise(F.lit(None if whole is None else whole[n]).cast("long"))
    return joined.select(F.col("lang").alias("group_lang"), F.col("source").alias("group_source"), *[pick(n).alias(n) for n in names])


def _verdicts(counts: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of `counts` with their ratios, joined with their group's thresholds, and both verdicts."""
    rows = counts.join(found, counts["lang"].eqNullSafe(F.col("group_lang")) & counts["source"].eqNullSafe(F.col("group_source")), "left")
    rows = rows.withColumns({f"{n}_ratio": ratio(n) for n in RATIOS})
    beyond = F.lit(False)
    for name, (*_, lower) in RATIOS.items():
        beyond = beyond | (F.col(f"{name}_ratio") > F.col(f"{name}_high"))
        if lower:
            beyond = beyond | (F.col(f"{name}_ratio") < F.col(f"{name}_low"))
    rows = rows.withColumn("base_failed", base_failed())
    return rows.withColumn("kept", ~F.col("base_failed") & ~F.coalesce(beyond, F.lit(False)))


def judge(documents: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """doc_id, lang, source, COUNTS, the ratios, `base_failed`, `kept` for each row of `documents`.

    Null and empty texts have no words and fail the base rules. A null language or source is a group like
    any other. Repeated rows are judged one by one. Without any text that passes the base rules there is no
    sketch and every text fails. Other columns of `documents` are not read.
    """
    counts = stored(text_counts(documents), "counts")
    rows = _verdicts(counts, thresholds(counts, min_group))
    return rows.select("doc_id", "lang", "source", *COUNTS, *[f"{n}_ratio" for n in RATIOS], "base_failed", "kept")


def keep(documents: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """The rows of `documents` that pass, with all their columns. Texts are counted twice and never shuffled."""
    found = thresholds(stored(text_counts(documents), "counts"), min_group)
    rows = text_counts(documents, F.struct(*documents.columns).alias("d"))
    return _verdicts(rows, found).where("kept").select("d.*")
