"""Driver-side contract checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from duelframe.errors import ValidationError


def require_columns(df: DataFrame, required: Sequence[str], name: str) -> None:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValidationError(f"{name} lacks required columns: {missing}")


def require_rows(df: DataFrame, name: str) -> None:
    """Runs a one-row job, so operators call it only where the caller asked for it."""
    if df.isEmpty():
        raise ValidationError(f"{name} has no rows")


def positive(value: int, name: str) -> int:
    if value <= 0:
        raise ValidationError(f"{name} must be positive, got {value}")
    return int(value)


def not_negative(value: int, name: str) -> int:
    if value < 0:
        raise ValidationError(f"{name} must not be negative, got {value}")
    return int(value)


def available(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    """The wanted columns the frame has, in the wanted order."""
    return [c for c in wanted if c in df.columns]
