"""Declared schemas, accepted column names and default column lists."""

from pyspark.sql import types as T

ENTITY_ID = "entity_id"
FIRST_ID, SECOND_ID, WINNER_ID = "first_id", "second_id", "winner_id"
CONTEST_KEY = [FIRST_ID, SECOND_ID, WINNER_ID]
METRIC_COLUMNS = ["total_battles", "total_wins", "win_rate", "weighted_score"]

ENTITY = T.StructType(
    [
        T.StructField(ENTITY_ID, T.LongType(), False),
        T.StructField("name", T.StringType(), False),
        T.StructField("type_1", T.StringType()),
        T.StructField("type_2", T.StringType()),
        T.StructField("generation", T.IntegerType()),
        T.StructField("legendary", T.BooleanType(), False),
        T.StructField("hp", T.IntegerType()),
        T.StructField("attack", T.IntegerType()),
        T.StructField("defense", T.IntegerType()),
        T.StructField("sp_attack", T.IntegerType()),
        T.StructField("sp_defense", T.IntegerType()),
        T.StructField("speed", T.IntegerType()),
    ]
)

CONTEST = T.StructType([T.StructField(c, T.LongType(), False) for c in CONTEST_KEY])

QUARANTINE = T.StructType(
    [
        T.StructField("page", T.LongType()),
        T.StructField("pos", T.IntegerType()),
        T.StructField("reason", T.StringType(), False),
        T.StructField("text", T.StringType()),
    ]
)

STAT_COLUMNS = ("hp", "attack", "defense", "sp_attack", "sp_defense", "speed")
OUTCOME_COLUMNS = ("win_rate", "weighted_score")

# --- fixed values -----------------------------------------------------------
# Field names of the incoming records, the key ceiling, the envelope keys and
# the true flags are facts about the data; they are spelled as the data spells them.

MAX_ENTITY_ID = 799

ENVELOPE_KEYS = ("results", "items", "data", "pokemons", "combats")

TRUE_WORDS = ("true", "1", "yes", "y", "t")

ENTITY_ALIASES = {
    ENTITY_ID: (ENTITY_ID, "pokemon_id", "id"),
    "type_1": ("type_1", "Type_1", "Type 1", "type1", "Type1"),
    "type_2": ("type_2", "Type_2", "Type 2", "type2", "Type2"),
    "hp": ("hp", "HP", "Hp"),
    "attack": ("attack", "Attack", "atk", "Atk"),
    "defense": ("defense", "Defense", "def", "Def"),
    "sp_attack": ("sp_attack", "Sp_Attack", "sp_atk", "Sp. Atk", "special_attack", "Special Attack"),
    "sp_defense": ("sp_defense", "Sp_Defense", "sp_def", "Sp. Def", "special_defense", "Special Defense"),
    "speed": ("speed", "Speed"),
}

CONTEST_ALIASES = {
    FIRST_ID: (FIRST_ID, "first_pokemon_id", "first_pokemon", "First_pokemon", "pokemon_1", "pokemon1"),
    SECOND_ID: (SECOND_ID, "second_pokemon_id", "second_pokemon", "Second_pokemon", "pokemon_2", "pokemon2"),
    WINNER_ID: (WINNER_ID, "winner", "Winner", "winner_pokemon"),
}
# --- end of fixed values ----------------------------------------------------
