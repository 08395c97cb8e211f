"""Entities and contests derived from the star-schema tables.

An entity is a part. A contest is an order line: its part against the part that has
the supplier's number, won by the part if the quantity is at least 25. The derivation
reads each line on its own, so it needs no shuffle and its contests come straight from
the scan; supplier numbers are few, which makes those entities hot keys.

The expressions are SQL that Spark and DuckDB both read, so one definition also feeds
the independent check queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENTITIES = {
    "entity_id": "p_partkey",
    "name": "p_name",
    "type_1": "p_type",
    "type_2": "p_brand",
    "generation": "CAST(substr(p_brand, 7) AS INT)",
    "legendary": "p_size >= 48",
    "hp": "p_size",
    "attack": "CAST(floor(p_retailprice) AS INT)",
    "defense": "CAST(length(p_name) AS INT)",
    "sp_attack": "CAST(length(p_type) AS INT)",
    "sp_defense": "CAST(substr(p_brand, 7) AS INT)",
    "speed": "CAST(p_size * 2 + length(p_name) AS INT)",
}

CONTESTS = {
    "first_id": "l_partkey",
    "second_id": "l_suppkey",
    "winner_id": "CASE WHEN l_quantity >= 25 THEN l_partkey ELSE l_suppkey END",
}

# What a load finds stored and gets sent. Numbers in twos and in threes overlap in part, as
# do contests decided by two quantities, so there is something to insert, replace and keep.
STORED_ENTITIES = {**ENTITIES, "entity_id": "p_partkey * 2", "type_2": "'OLD'", "attack": "CAST(floor(p_retailprice) AS INT) - 1"}
INCOMING_ENTITIES = {
    **ENTITIES,
    "entity_id": "p_partkey * 3",
    "type_2": "CASE WHEN length(p_name) > 9 THEN p_brand END",
}
STORED_CONTESTS = {**CONTESTS, "winner_id": "CASE WHEN l_quantity >= 30 THEN l_partkey ELSE l_suppkey END"}

# A stored entity that takes part in every third contest and an unknown one in every seventh.
HOT_CONTESTS = {
    **CONTESTS,
    "first_id": "CASE WHEN l_orderkey % 3 = 0 THEN 4 ELSE l_partkey END",
    "second_id": "CASE WHEN l_orderkey % 7 = 0 THEN 5 ELSE l_suppkey END",
}

# The same parts and lines as a careless source would send them: other column names,
# text where numbers are due, combined and blank categories, unknown and missing ids.
RAW_ENTITIES = {
    "id": """CASE WHEN p_size = 50 THEN 'x' WHEN p_size = 49 THEN concat(' ', CAST(p_partkey AS STRING), ' ')
        WHEN p_size = 47 THEN concat(CAST(p_partkey AS STRING), '.0')
        WHEN p_size = 45 THEN concat(CAST(p_partkey AS STRING), '.5')
        WHEN p_size = 46 THEN NULL ELSE CAST(p_partkey AS STRING) END""",
    "name": "CASE WHEN p_size = 21 THEN NULL ELSE p_name END",
    "Type 1": """CASE WHEN p_size < 10 THEN concat(p_type, '/', p_brand)
        WHEN p_size < 15 THEN concat(' ', p_type, ' , ', p_brand, ' / Z')
        WHEN p_size < 18 THEN concat(p_type, '|', p_brand)
        WHEN p_size = 18 THEN ' ' WHEN p_size = 19 THEN NULL WHEN p_size = 20 THEN '/' ELSE p_type END""",
    "Type 2": "CASE WHEN p_retailprice < 920 THEN NULL WHEN p_retailprice < 930 THEN ' ' ELSE concat(p_brand, ' ') END",
    "generation": """CASE WHEN p_size = 30 THEN 'x' WHEN p_size = 31 THEN '3.0' WHEN p_size = 32 THEN '3.5'
        ELSE substr(p_brand, 7) END""",
    "legendary": """CASE WHEN p_size < 4 THEN ' Yes ' WHEN p_size < 8 THEN 'T' WHEN p_size < 12 THEN '1'
        WHEN p_size < 16 THEN '1.0' WHEN p_size < 20 THEN NULL WHEN p_size < 24 THEN 'TRUE'
        WHEN p_size < 28 THEN 'y' ELSE 'no' END""",
    "HP": "CAST(p_size AS STRING)",
    "Atk": """CASE WHEN p_size = 33 THEN 'strong' WHEN p_size = 34 THEN '45.5'
        ELSE CAST(CAST(floor(p_retailprice) AS INT) AS STRING) END""",
    "Def": "CAST(length(p_name) AS DOUBLE) + 0.9",
    "Sp. Atk": "CAST(length(p_type) AS INT)",
    "special_defense": "CAST(substr(p_brand, 7) AS INT)",
}

RAW_CONTESTS = {
    "First_pokemon": """CASE WHEN l_linenumber = 7 AND l_quantity >= 45 THEN 'x'
        WHEN l_linenumber = 6 AND l_quantity >= 45 THEN NULL
        WHEN l_linenumber = 5 AND l_quantity >= 45 THEN CAST(l_partkey + 1000000000 AS STRING)
        ELSE CAST(l_partkey AS STRING) END""",
    "pokemon_2": """CASE WHEN l_linenumber = 4 AND l_quantity >= 45 THEN concat(' ', CAST(l_suppkey AS STRING), '.0 ')
        WHEN l_linenumber = 3 AND l_quantity >= 45 THEN concat(CAST(l_suppkey AS STRING), '.5')
        ELSE CAST(l_suppkey AS STRING) END""",
    "winner": """CASE WHEN l_linenumber = 2 AND l_quantity >= 45 THEN NULL
        WHEN l_linenumber = 1 AND l_quantity >= 45 THEN CAST(l_orderkey AS STRING)
        WHEN l_quantity >= 25 THEN CAST(l_partkey AS STRING) ELSE CAST(l_suppkey AS STRING) END""",
}

# A part's record as its source spells it, and one page of text around each record.
_RECORD = """to_json(named_struct('id', p_partkey, 'name', p_name, 'types', concat(p_type, '/', p_brand),
    'generation', substr(p_brand, 7), 'legendary', p_size >= 40, 'HP', p_size,
    'Attack', CAST(floor(p_retailprice) AS INT), 'Sp. Atk', length(p_type), 'special_defense', length(p_name)))"""
_SECOND = "to_json(named_struct('id', p_partkey + 1000000000, 'name', p_name, 'type_1', p_type))"

ENTITY_PAGE = f"""CASE WHEN p_size <= 10 THEN concat('[', {_RECORD}, ']')
    WHEN p_size <= 20 THEN concat('{{"results":[', {_RECORD}, ']}}')
    WHEN p_size <= 25 THEN concat('{{"items":[', {_RECORD}, ']}}')
    WHEN p_size <= 30 THEN concat('{{"results":"none","data":[', {_RECORD}, ',3]}}')
    WHEN p_size <= 35 THEN concat('{{"pokemons":[', {_RECORD}, ']}}')
    WHEN p_size <= 40 THEN concat('{{"combats":[', {_RECORD}, ']}}')
    WHEN p_size <= 44 THEN concat('{{"count":2,"results":[', {_RECORD}, ',', {_SECOND}, ']}}')
    WHEN p_size <= 46 THEN '{{"detail":"not found"}}'
    WHEN p_size = 47 THEN '{{"results":['
    WHEN p_size = 48 THEN '[]'
    ELSE concat('[', {_RECORD}, ',null]') END"""

# Three records, of which the second repeats a field and the third repeats one further inside.
REPEATED_KEY_PAGE = """concat('[', to_json(named_struct('id', p_partkey, 'name', p_name, 'hp', p_size)), ',{"id":1,"hp":7,"id":', CAST(p_partkey AS STRING),
    ',"hp":', CAST(p_size + 1 AS STRING), '},{"id":2,"more":{"a":1,"a":2}}]')"""
NAMELESS_PAGE = """concat('[', to_json(named_struct('id', p_partkey + 2000000000, 'hp', p_size)), ']')"""
LONG_PAGE = "concat('{\"detail\":\"', repeat(p_name, 100), '\"}')"

CONTEST_PAGE = """concat('{"combats":[', to_json(named_struct('first_pokemon', l_partkey, 'second_pokemon', l_suppkey,
    'winner', CASE WHEN l_quantity >= 25 THEN l_partkey ELSE l_suppkey END)), ']}')"""


# Declared, so that no job has to read file footers before a query can be planned.
SCHEMAS = {
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,
        l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,
        l_shipdate timestamp_ntz""",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def derive(df: DataFrame, expressions: dict[str, str]) -> DataFrame:
    return df.select(*[F.expr(text).alias(name) for name, text in expressions.items()])


def entities(spark: SparkSession, folder: str) -> DataFrame:
    return derive(table(spark, folder, "part"), ENTITIES)


def contests(spark: SparkSession, folder: str) -> DataFrame:
    return derive(table(spark, folder, "lineitem"), CONTESTS)


def raw_entities(spark: SparkSession, folder: str) -> DataFrame:
    return derive(table(spark, folder, "part"), RAW_ENTITIES)


def raw_contests(spark: SparkSession, folder: str) -> DataFrame:
    return derive(table(spark, folder, "lineitem"), RAW_CONTESTS)


def entity_pages(spark: SparkSession, folder: str) -> DataFrame:
    return derive(table(spark, folder, "part"), {"page": "p_partkey", "raw": ENTITY_PAGE})


def repeated_key_pages(spark: SparkSession, folder: str) -> DataFrame:
    return derive(table(spark, folder, "part"), {"page": "p_partkey", "raw": REPEATED_KEY_PAGE})


def nameless_pages(spark: SparkSession, folder: str) -> DataFrame:
    return derive(table(spark, folder, "part"), {"page": "p_partkey", "raw": NAMELESS_PAGE})


def long_pages(spark: SparkSession, folder: str) -> DataFrame:
    return derive(table(spark, folder, "part"), {"page": "p_partkey", "raw": LONG_PAGE})


def contest_pages(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    return derive(lines, {"page": "l_orderkey", "raw": CONTEST_PAGE})
