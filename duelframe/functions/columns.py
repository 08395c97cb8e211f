"""Column helpers: coercions, clipping and the outcome formulas.

Everything here is a built-in Spark expression, so it stays inside whole-stage
code generation and is safe under ANSI mode (no cast or division can raise).
The coercions take the column's type as well, so that a column that already has
the wanted type costs nothing and keeps its filters pushable to the scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duelframe.schemas import TRUE_WORDS

# Every character Unicode counts as white space; Spark's trim() knows only the blank.
WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())

# Numbers as text; it keeps out Java-only spellings such as '1d', '0x1p3' and 'NaN'.
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def named(name: str) -> Column:
    """A column by exact name, also when the name has dots or blanks."""
    return F.col("`" + name.replace("`", "``") + "`")


def quoted(text: str) -> str:
    """A text as SQL literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def stacked(rows: Sequence[Sequence[str]], names: Sequence[str]) -> Column:
    """Rows of SQL expressions over one row, as that many rows with these column names."""
    cells = ", ".join(cell for row in rows for cell in row)
    ticked = ", ".join("`" + n.replace("`", "``") + "`" for n in names)
    return F.expr(f"stack({len(rows)}, {cells}) AS ({ticked})")


def dtype(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def clean_text(c: Column) -> Column:
    """Trimmed text; blank becomes NULL."""
    return F.nullif(strip(c.cast("string")), F.lit(""))


def to_double(c: Column, t: T.DataType) -> Column:
    """Number as double; anything that is not a finite-syntax number, and NaN, is NULL."""
    if isinstance(t, (T.FloatType, T.DoubleType)):
        d = c.cast("double")
        return F.when(~F.isnan(d), d)
    if isinstance(t, (T.NumericType, T.BooleanType)):
        return c.cast("double")
    text = c.cast("string")
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def to_long(c: Column, t: T.DataType) -> Column:
    """Whole number as bigint; fractions and non-numbers are NULL."""
    if isinstance(t, (T.IntegralType, T.BooleanType)):
        return c.cast("bigint")
    if isinstance(t, T.StringType):
        # Plain digits are read directly, which is cheap and keeps every digit of a long id.
        number = c.try_cast("decimal(38,18)")
        return F.coalesce(c.try_cast("bigint"), F.when(number == F.floor(number), number.try_cast("bigint")))
    number = c if isinstance(t, T.DecimalType) else to_double(c, t)
    return F.when(number == F.floor(number), number.try_cast("bigint"))


def to_int(c: Column, t: T.DataType) -> Column:
    """Integer or NULL: numbers are truncated, text must be a plain integer."""
    if isinstance(t, T.IntegerType):
        return c
    if isinstance(t, (T.NumericType, T.BooleanType)):
        return c.try_cast("int")
    return c.cast("string").try_cast("int")


def to_bool(c: Column, t: T.DataType) -> Column:
    if isinstance(t, T.BooleanType):
        return F.coalesce(c, F.lit(False))
    word = F.lower(strip(c.cast("string")))
    return F.coalesce(word.isin(*TRUE_WORDS), F.lit(False))


def filled(c: Column, t: T.DataType, fill: float = 0.0) -> Column:
    """Number as double with a fill value in place of what is missing."""
    return F.coalesce(to_double(c, t), F.lit(float(fill)))


def computed_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """The frame with these columns set, each evaluated exactly once per row.

    A filter on a projected column is pushed below the projection with a copy of the
    column's whole expression, and every later join on it adds such a filter. For costly
    expressions that multiplies the work. What a generator puts out is not copied, so
    the values go through a one-element inline.
    """
    kept = [named(c) for c in df.columns if c not in columns]
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    order = [*[c for c in df.columns if c not in columns], *columns]
    out = df.select(*kept, F.inline(F.array(row)))
    wanted = [*df.columns, *[c for c in columns if c not in df.columns]]
    return out if order == wanted else out.select(*[named(c) for c in wanted])


def missing_last(c: Column, t: T.DataType) -> Column:
    """A sort key in which NaN counts as missing."""
    return F.when(~F.isnan(c), c) if isinstance(t, (T.FloatType, T.DoubleType)) else c


def clip(c: Column, low: float, high: float) -> Column:
    """Bounded value. NULL stays NULL, which least/greatest alone would not keep."""
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(low)), F.lit(high)))


def win_rate(battles: Column, wins: Column) -> Column:
    """wins / battles within [0, 1]; a win without any battle counts as 1, nothing at all as 0."""
    return (
        F.when(battles > 0, clip(F.try_divide(wins.cast("double"), battles.cast("double")), 0.0, 1.0))
        .when(wins > 0, F.lit(1.0))
        .otherwise(F.lit(0.0))
    )


def weighted_score(rate: Column, battles: Column) -> Column:
    """Rate weighted by experience: rate * (1 + ln(1 + battles))."""
    return rate * (F.lit(1.0) + F.log1p(battles.cast("double")))


def win_rate_pct(wins: Column, battles: Column) -> Column:
    """Percentage within [0, 100]; without battles it is 0."""
    ratio = F.try_divide(wins.cast("double"), battles.cast("double")) * F.lit(100.0)
    return F.coalesce(clip(ratio, 0.0, 100.0), F.lit(0.0))


def round_to(c: Column, digits: int) -> Column:
    """Round half to even on the scaled value."""
    scale = float(10**digits)
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def format_fixed(c: Column, digits: int, suffix: str = "") -> Column:
    """Text with a fixed number of decimals, rounded half to even from the exact binary value.

    With a pattern, format_number rounds as printf does and takes numbers of any size; with a number of
    digits it would group thousands. NaN counts as missing, here as elsewhere.
    """
    x = c.cast("double")
    pattern = "0." + "0" * digits if digits else "0"
    return F.concat(F.call_function("format_number", F.when(~F.isnan(x), x), F.lit(pattern)), F.lit(suffix))


def truncate(c: Column, limit: int = 500) -> Column:
    """Text for a log or a preview, cut with an ellipsis."""
    return F.when(F.length(c) > limit, F.concat(F.left(c, F.lit(limit)), F.lit("..."))).otherwise(c)
