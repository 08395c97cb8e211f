"""Display labels, tiers and text forms used by the report frames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from duelframe.functions.columns import clean_text, format_fixed, quoted

# --- fixed values -----------------------------------------------------------
STAT_LABELS = {
    "hp": "HP",
    "attack": "Ataque",
    "defense": "Defesa",
    "sp_attack": "Ataque Especial",
    "sp_defense": "Defesa Especial",
    "speed": "Velocidade",
}

PROFILE_LABELS = {
    "attack": "Ataque",
    "defense": "Defesa",
    "hp": "HP",
    "speed": "Velocidade",
    "sp_attack": "Esp. Ataque",
}

TABLE_LABELS = {
    "type": "Tipo",
    "name": "Pokémon",
    "total_wins": "Vitórias",
    "total_battles": "Batalhas",
    "win_rate_pct": "Win Rate (%)",
}

CORRELATION_TIERS = ((0.7, "high"), (0.5, "medium"), (0.3, "low"))
CORRELATION_TIER_BELOW = "minimal"

WIN_RATE_TIERS = ((95.0, "very high"), (90.0, "high"), (85.0, "medium"))
WIN_RATE_TIER_BELOW = "low"

POSITIVE, NEGATIVE = "Positiva ↑", "Negativa ↓"
CHECK_OK, CHECK_FAILED = "OK", "FALHA"
# --- end of fixed values ----------------------------------------------------


def label(c: Column, labels: Mapping[str, str]) -> Column:
    """The label of a key; a key without one is its own label."""
    if not labels:
        return c
    pairs = ", ".join(f"{quoted(key)}, {quoted(text)}" for key, text in labels.items())
    return F.coalesce(F.try_element_at(F.expr(f"map({pairs})"), c), c)


def tier(c: Column, steps: Sequence[tuple[float, str]], below: str) -> Column:
    """Name of the first step, from the highest down, that the value reaches."""
    chosen = F.when(c.isNull(), F.lit(None).cast("string"))
    for bound, text in steps:
        chosen = chosen.when(c >= bound, F.lit(text))
    return chosen.otherwise(F.lit(below))


def correlation_tier(r: Column) -> Column:
    return tier(F.abs(r), CORRELATION_TIERS, CORRELATION_TIER_BELOW)


def win_rate_tier(pct: Column) -> Column:
    return tier(pct, WIN_RATE_TIERS, WIN_RATE_TIER_BELOW)


def direction(r: Column) -> Column:
    return F.when(r > 0, F.lit(POSITIVE)).when(r.isNotNull(), F.lit(NEGATIVE))


def joined_types(first: Column, second: Column, separator: str = " / ") -> Column:
    return F.concat_ws(separator, clean_text(first), clean_text(second))


def best_row_message(name: Column, wins: Column, battles: Column, pct: Column) -> Column:
    return F.concat(
        F.lit("Top do tipo = "), name, F.lit(" com "),
        format_fixed(wins, 1), F.lit("/"), format_fixed(battles, 1),
        F.lit(" = "), format_fixed(pct, 2, "%"),
    )
