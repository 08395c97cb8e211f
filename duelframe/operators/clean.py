"""Cleaning: column aliases, category splitting, coercions and the key range.

All of it is projection and filter, so cleaning adds no shuffle and runs in the
same stage as the scan in front of it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duelframe.functions.columns import (
    clean_text, computed_once, dtype, named, strip, to_bool, to_double, to_long,
)
from duelframe.operators.checks import require_rows
from duelframe.schemas import (
    CONTEST_ALIASES, CONTEST_KEY, ENTITY_ALIASES, ENTITY_ID,
)


def resolve_aliases(df: DataFrame, aliases: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rename the first accepted spelling of each target column to the target.

    Spelling is matched in exact case, while Spark looks names up without case; so
    columns are renamed by position, and one that differs from a kept column only in
    case (``HP`` next to ``hp``) is left out, as no query could name it.
    """
    names = df.columns
    renamed = dict(enumerate(names))
    for target, spellings in aliases.items():
        if target in names:
            continue
        hit = next((s for s in spellings if s in names), None)
        if hit is not None:
            renamed[names.index(hit)] = target
    canonical = {new.lower(): i for i, new in renamed.items() if new in aliases}
    kept = [i for i, new in renamed.items() if canonical.get(new.lower(), i) == i]
    if renamed == dict(enumerate(names)) and len(kept) == len(names):
        return df
    by_position = df.toDF(*[f"c{i}" for i in range(len(names))])
    return by_position.select(*[F.col(f"c{i}").alias(renamed[i]) for i in kept])


def category_parts(raw: Column, t: T.DataType | None = None) -> Column:
    """The non-blank parts of a combined category value, as an array."""
    if isinstance(t, T.ArrayType):
        parts = raw
    else:
        parts = F.split(raw.cast("string"), r"[/,|]")
    return F.filter(F.transform(parts, strip), lambda p: p != "")


def split_types_column(df: DataFrame) -> DataFrame:
    """Fill an absent type_1 / type_2 column from the parts of ``types``."""
    absent = [c for c in ("type_1", "type_2") if c not in df.columns]
    if "types" not in df.columns or not absent:
        return df
    parts = category_parts(F.col("types"), dtype(df, "types"))
    position = {"type_1": 0, "type_2": 1}
    return df.withColumns({c: F.get(parts, F.lit(position[c])) for c in absent})


def split_combined_type(df: DataFrame) -> DataFrame:
    """Split a type_1 such as ``A/B``; the second part fills only a missing type_2."""
    if "type_1" not in df.columns:
        return df
    if "type_2" not in df.columns:
        df = df.withColumn("type_2", F.lit(None).cast("string"))
    first = F.col("type_1").cast("string")
    second = F.col("type_2").cast("string")
    combined = F.coalesce(first.rlike("[/,]"), F.lit(False))
    parts = category_parts(first)
    return df.withColumns(
        {
            "type_1": clean_text(F.when(combined, F.get(parts, F.lit(0))).otherwise(first)),
            "type_2": clean_text(
                F.when(combined & second.isNull(), F.get(parts, F.lit(1))).otherwise(second)
            ),
        }
    )


def coerce_flag(df: DataFrame, column: str = "legendary") -> DataFrame:
    """Flag column as boolean; where the column is absent it is False."""
    if column not in df.columns:
        return df.withColumn(column, F.lit(False))
    return df.withColumn(column, to_bool(named(column), dtype(df, column)))


def within_key_range(
    df: DataFrame, columns: Sequence[str] = (ENTITY_ID,), max_id: int | None = None
) -> DataFrame:
    """Keep rows whose keys are all numeric and at most ``max_id``; None only asks for a number."""
    for name in columns:
        t = dtype(df, name)
        c = named(name)
        # Integer keys are compared as they are, which lets the filter reach the scan.
        key = c if isinstance(t, T.IntegralType) else to_double(c, t)
        df = df.filter(key.isNotNull() if max_id is None else key <= F.lit(max_id))
    return df


def clean_entities(
    df: DataFrame,
    *,
    legendary_column: str = "legendary",
    max_id: int | None = None,
    require_input: bool = False,
) -> DataFrame:
    """Canonical column names, split categories, coerced flag and generation, keys in range."""
    if require_input:
        require_rows(df, "entities")
    out = resolve_aliases(df, ENTITY_ALIASES)
    if "generation" in out.columns:
        whole = to_long(F.col("generation"), dtype(out, "generation"))
        out = out.withColumn("generation", whole.try_cast("int"))
    out = split_types_column(out)
    out = split_combined_type(out)
    out = coerce_flag(out, legendary_column)
    if ENTITY_ID in out.columns:
        out = within_key_range(out, [ENTITY_ID], max_id)
        if not isinstance(dtype(out, ENTITY_ID), T.LongType):
            out = out.withColumn(ENTITY_ID, to_long(F.col(ENTITY_ID), dtype(out, ENTITY_ID)))
    return out


def clean_contests(df: DataFrame) -> DataFrame:
    """Canonical column names with bigint keys; what is not a whole number becomes NULL."""
    out = resolve_aliases(df, CONTEST_ALIASES)
    changed = {
        c: to_long(F.col(c), dtype(out, c))
        for c in CONTEST_KEY
        if c in out.columns and not isinstance(dtype(out, c), T.LongType)
    }
    return computed_once(out, changed) if changed else out
