"""Check queries for DuckDB, written from the definitions and not from the Spark plans."""

from __future__ import annotations

from duelframe.sources import bridge


def _select(expressions: dict[str, str], source: str) -> str:
    columns = ", ".join(f'{text} AS "{name}"' for name, text in expressions.items())
    return f"SELECT {columns} FROM {source}"


ENTITY_COLUMNS = ", ".join(bridge.ENTITIES)

_RATE = """CASE WHEN total_battles > 0 THEN least(total_wins::DOUBLE / total_battles, 1::DOUBLE)
    WHEN total_wins > 0 THEN 1::DOUBLE ELSE 0::DOUBLE END"""


def _metrics(prefix: str, entities: str, contests: str) -> str:
    return f"""
{prefix}battles AS (SELECT id, count(*) AS n FROM (SELECT first_id AS id FROM {contests}
    UNION ALL SELECT second_id FROM {contests}) u WHERE id IS NOT NULL GROUP BY id),
{prefix}wins AS (SELECT winner_id AS id, count(*) AS n FROM {contests} WHERE winner_id IS NOT NULL GROUP BY winner_id),
{prefix}met0 AS (SELECT e.*, coalesce(b.n, 0)::BIGINT AS total_battles, coalesce(w.n, 0)::BIGINT AS total_wins
    FROM {entities} e LEFT JOIN {prefix}battles b ON e.entity_id = b.id LEFT JOIN {prefix}wins w ON e.entity_id = w.id),
{prefix}met AS (SELECT *, round(win_rate * (1 + ln(1 + total_battles)), 9) AS weighted_score
    FROM (SELECT *, {_RATE} AS win_rate FROM {prefix}met0) m)"""


# A number as text: DOUBLE if it reads as one; a whole one as BIGINT.
def _whole(c: str) -> str:
    d = f"TRY_CAST(trim({c}) AS DOUBLE)"
    return f"CASE WHEN {d} = floor({d}) THEN CAST({d} AS BIGINT) END"


def _plain_int(c: str) -> str:
    return f"CASE WHEN regexp_full_match(trim({c}), '[+-]?[0-9]+') THEN CAST(trim({c}) AS INTEGER) END"


_STATS = ["hp", "attack", "defense", "sp_attack", "sp_defense", "speed"]
_CORR = " UNION ALL ".join(
    f"""SELECT '{s}' AS stat, '{m}' AS metric,
    round(CASE WHEN isnan(corr({s}, {m})) THEN NULL ELSE corr({s}, {m}) END, 9) AS r, count({s}) AS n FROM met"""
    for s in _STATS
    for m in ("win_rate", "weighted_score")
)

_LABELS = """CASE stat WHEN 'hp' THEN 'HP' WHEN 'attack' THEN 'Ataque' WHEN 'defense' THEN 'Defesa'
    WHEN 'sp_attack' THEN 'Ataque Especial' WHEN 'sp_defense' THEN 'Defesa Especial'
    WHEN 'speed' THEN 'Velocidade' ELSE stat END"""

BASE = f"""WITH ent AS ({_select(bridge.ENTITIES, 'part')}),
con AS ({_select(bridge.CONTESTS, 'lineitem')}),
raw_ent AS ({_select(bridge.RAW_ENTITIES, 'part')}),
raw_con AS ({_select(bridge.RAW_CONTESTS, 'lineitem')}),
ccon AS (SELECT {_whole('"First_pokemon"')} AS first_id, {_whole('"pokemon_2"')} AS second_id,
    {_whole('"winner"')} AS winner_id FROM raw_con),
cent0 AS (SELECT *, regexp_matches("Type 1", '[/,]') AS combined,
    list_filter(list_transform(regexp_split_to_array("Type 1", '[/,|]'), lambda x: trim(x)), lambda x: x <> '') AS parts
    FROM raw_ent),
cent AS (SELECT {_whole('id')} AS entity_id, name,
    nullif(trim(CASE WHEN combined THEN parts[1] ELSE "Type 1" END), '') AS type_1,
    nullif(trim(CASE WHEN combined AND "Type 2" IS NULL THEN parts[2] ELSE "Type 2" END), '') AS type_2,
    CAST({_whole('generation')} AS INTEGER) AS generation,
    coalesce(lower(trim(legendary)) IN ('true', '1', 'yes', 'y', 't'), false) AS legendary,
    "HP" AS hp, "Atk" AS attack, "Def" AS defense, "Sp. Atk" AS sp_attack, special_defense AS sp_defense
    FROM cent0 WHERE TRY_CAST(trim(id) AS DOUBLE) IS NOT NULL),
{_metrics('', 'ent', 'con')},
{_metrics('raw_', 'ent', 'ccon')},
long AS (SELECT entity_id, name, win_rate, total_battles, total_wins, 'type_1' AS type_source, trim(type_1) AS type
    FROM met WHERE trim(type_1) <> '' UNION ALL
    SELECT entity_id, name, win_rate, total_battles, total_wins, 'type_2', trim(type_2) FROM met WHERE trim(type_2) <> ''),
pct AS (SELECT *, least(total_wins::DOUBLE / total_battles * 100, 100::DOUBLE) AS win_rate_pct
    FROM long WHERE total_battles > 0),
by_type AS (SELECT *, CAST(row_number() OVER (PARTITION BY type
    ORDER BY win_rate_pct DESC, total_battles DESC, entity_id, type_source) AS INTEGER) AS position FROM pct),
cor AS ({_CORR}),
infl AS (SELECT stat, {_LABELS} AS label, r, abs(r) AS strength,
    CASE WHEN abs(r) >= 0.7 THEN 'high' WHEN abs(r) >= 0.5 THEN 'medium' WHEN abs(r) >= 0.3 THEN 'low' ELSE 'minimal' END AS tier,
    CASE WHEN r > 0 THEN 'Positiva ↑' ELSE 'Negativa ↓' END AS direction,
    CAST(row_number() OVER (ORDER BY abs(r) DESC, stat) AS INTEGER) AS position,
    CAST(row_number() OVER (ORDER BY abs(r), stat) AS INTEGER) AS position_from_least,
    count(*) OVER () AS ranked FROM cor WHERE metric = 'win_rate' AND r IS NOT NULL),
old_ent AS ({_select(bridge.STORED_ENTITIES, 'part')}),
new_ent AS ({_select(bridge.INCOMING_ENTITIES, 'part')}),
old_con AS (SELECT DISTINCT * FROM ({_select(bridge.STORED_CONTESTS, 'lineitem')}) o),
recs AS (SELECT p_partkey AS page, CAST(0 AS INTEGER) AS pos, p_partkey AS id, p_size AS size, p_name, p_type, p_brand,
    p_retailprice, false AS extra FROM part WHERE p_size <= 44 OR p_size >= 49
    UNION ALL SELECT p_partkey, 1, p_partkey + 1000000000, p_size, p_name, p_type, p_brand, p_retailprice, true
    FROM part WHERE p_size > 40 AND p_size <= 44),
landed AS (SELECT page, pos, CAST(id AS VARCHAR) AS entity_id, p_name AS name, p_type AS type_1,
    CASE WHEN extra THEN NULL ELSE p_brand END AS type_2,
    CASE WHEN extra THEN NULL ELSE substr(p_brand, 7) END AS generation,
    CASE WHEN extra THEN NULL WHEN size >= 40 THEN 'true' ELSE 'false' END AS legendary,
    CASE WHEN extra THEN NULL ELSE size END AS hp,
    CASE WHEN extra THEN NULL ELSE CAST(floor(p_retailprice) AS INTEGER) END AS attack,
    CAST(NULL AS INTEGER) AS defense,
    CASE WHEN extra THEN NULL ELSE CAST(length(p_type) AS INTEGER) END AS sp_attack,
    CASE WHEN extra THEN NULL ELSE CAST(length(p_name) AS INTEGER) END AS sp_defense,
    CAST(NULL AS INTEGER) AS speed FROM recs),
job_ent AS (SELECT CAST(entity_id AS BIGINT) AS entity_id, name, type_1, type_2,
    CAST(generation AS INTEGER) AS generation, coalesce(legendary = 'true', false) AS legendary,
    CAST(hp AS INTEGER) AS hp, CAST(attack AS INTEGER) AS attack, CAST(defense AS INTEGER) AS defense,
    CAST(sp_attack AS INTEGER) AS sp_attack, CAST(sp_defense AS INTEGER) AS sp_defense,
    CAST(speed AS INTEGER) AS speed FROM landed),
job_con AS (SELECT DISTINCT * FROM con WHERE first_id IN (SELECT entity_id FROM job_ent)
    AND second_id IN (SELECT entity_id FROM job_ent) AND winner_id IN (SELECT entity_id FROM job_ent)),
{_metrics('job_', 'job_ent', 'job_con')},
keyed AS (SELECT CASE WHEN ok THEN first_id END AS first_id, CASE WHEN ok THEN second_id END AS second_id,
    CASE WHEN ok THEN winner_id END AS winner_id FROM (SELECT *, first_id IS NOT NULL AND second_id IS NOT NULL
    AND winner_id IS NOT NULL AS ok FROM ccon) k),
classified AS (SELECT k.*, CASE WHEN first_id IS NULL THEN 'out_of_range'
    WHEN first_id NOT IN (SELECT entity_id FROM ent) OR second_id NOT IN (SELECT entity_id FROM ent)
      OR winner_id NOT IN (SELECT entity_id FROM ent) THEN 'unknown_entity'
    WHEN EXISTS (SELECT 1 FROM old_con o WHERE o.first_id = k.first_id AND o.second_id = k.second_id
      AND o.winner_id = k.winner_id) THEN 'present' ELSE 'new' END AS status
    FROM (SELECT first_id, second_id, winner_id, count(*) AS copies FROM keyed GROUP BY ALL) k),
con7 AS ({_select(bridge.CONTESTS, 'lineitem')} WHERE l_linenumber = 7),
{_metrics('seven_', 'ent', 'con7')},
two_con AS (SELECT * FROM (SELECT * FROM con UNION SELECT * FROM old_con) t WHERE first_id IN (SELECT entity_id FROM ent)
    AND second_id IN (SELECT entity_id FROM ent) AND winner_id IN (SELECT entity_id FROM ent)),
{_metrics('two_', 'ent', 'two_con')},
hot_con AS ({_select(bridge.HOT_CONTESTS, 'lineitem')}),
left_con AS (SELECT * FROM con EXCEPT SELECT * FROM old_con),
idle_con AS (SELECT DISTINCT * FROM con WHERE first_id IN (SELECT entity_id FROM old_ent)
    AND second_id IN (SELECT entity_id FROM old_ent) AND winner_id IN (SELECT entity_id FROM old_ent))
"""


def _team(size: int, category: str, diverse: bool = True) -> str:
    first = f"rn = 1 OR coalesce(trim({category}), '') = ''" if diverse else "true"
    return f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY trim({category})
        ORDER BY weighted_score DESC, entity_id) AS rn FROM met) t
        ORDER BY CASE WHEN {first} THEN 0 ELSE 1 END, weighted_score DESC, entity_id LIMIT {size}"""


def _quality(null_ids: str, duplicate_ids: str, contests: str, metrics: str) -> str:
    n = f"(SELECT count(*) FROM {contests})"
    checks = [
        ("pokemon_id nulo", null_ids, "0"),
        ("pokemon_id duplicado", duplicate_ids, "0"),
        ("winner nulo", f"(SELECT count(*) FROM {contests} WHERE winner_id IS NULL)", "0"),
        (
            "winner fora do par",
            f"""(SELECT count(*) FROM {contests} WHERE winner_id IS NULL OR NOT
            (coalesce(winner_id = first_id, false) OR coalesce(winner_id = second_id, false)))""",
            "0",
        ),
        ("soma total_battles", f"(SELECT sum(total_battles)::BIGINT FROM {metrics})", f"2 * {n}"),
        ("soma total_wins", f"(SELECT sum(total_wins)::BIGINT FROM {metrics})", n),
    ]
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS "check", CAST({value} AS BIGINT) AS result,
        CASE WHEN {value} = {expected} THEN 'OK' ELSE 'FALHA' END AS status"""
        for name, value, expected in checks
    )


_CARD = "printf('%.1f', win_rate_pct) || '%'"

def _team_cards(size: int) -> str:
    return f"""SELECT CAST(row_number() OVER (ORDER BY total_wins DESC, entity_id) AS INTEGER) AS position,
        entity_id, name, type_1 || '/' || type_2 AS type_label, type_1 || ' / ' || type_2 AS type_text,
        total_wins, total_battles, weighted_score, 'Score: ' || printf('%.1f', weighted_score) AS score_text
        FROM ({_team(size, "type_1")}) t"""


BODIES = {
    "entity_scan": "SELECT * FROM ent",
    "contest_scan": "SELECT * FROM con",
    "entity_lookup": "SELECT * FROM ent WHERE entity_id = 42",
    "total_battles": "SELECT id AS entity_id, n AS total_battles FROM battles",
    "total_wins": "SELECT id AS entity_id, n AS total_wins FROM wins",
    "outcome_counts": """SELECT coalesce(b.id, w.id) AS entity_id, coalesce(b.n, 0) AS total_battles,
        coalesce(w.n, 0) AS total_wins FROM battles b FULL JOIN wins w ON b.id = w.id""",
    "outcome_metrics": "SELECT * FROM met",
    "outcome_metrics_raw_contests":
        "SELECT entity_id, total_battles, total_wins, win_rate, weighted_score FROM raw_met",
    "ranking_by_score": "SELECT * FROM met ORDER BY weighted_score DESC, entity_id LIMIT 10",
    "ranking_full": "SELECT entity_id, name, weighted_score FROM met ORDER BY weighted_score DESC, entity_id",
    "ranking_positions": "SELECT entity_id, weighted_score, row_number() OVER (ORDER BY weighted_score DESC, entity_id) AS position FROM met",
    "top_win_rate": "SELECT * FROM met WHERE total_battles >= 30 ORDER BY win_rate DESC, entity_id LIMIT 20",
    "category_win_rate": """SELECT type, sum(total_battles)::BIGINT AS total_battles, sum(total_wins)::BIGINT AS total_wins,
        least(sum(total_wins)::DOUBLE / sum(total_battles)::DOUBLE, 1::DOUBLE) AS mean_win_rate,
        sum(total_battles)::BIGINT AS sample_size FROM long WHERE total_battles > 0 GROUP BY type""",
    "categories_long": "SELECT * FROM long",
    "category_list": "SELECT DISTINCT type FROM long",
    "best_by_category": "SELECT type, name, total_wins, total_battles, win_rate_pct FROM by_type WHERE position = 1",
    "top_n_by_category": "SELECT * FROM by_type WHERE position <= 5",
    "top_n_in_category": "SELECT * FROM by_type WHERE position <= 5 AND type = 'ECONOMY'",
    "attribute_correlation": "SELECT * FROM cor",
    "correlation_matrix": """SELECT stat, max(CASE WHEN metric = 'win_rate' THEN r END) AS win_rate,
        max(CASE WHEN metric = 'weighted_score' THEN r END) AS weighted_score FROM cor GROUP BY stat""",
    "attribute_profile": """SELECT stat, label, round(mean, 9) AS mean, round(mean / max(mean) OVER () * 100, 9) AS scaled FROM (
        SELECT 'attack' AS stat, 'Ataque' AS label, avg(attack) AS mean FROM met UNION ALL
        SELECT 'defense', 'Defesa', avg(defense) FROM met UNION ALL SELECT 'hp', 'HP', avg(hp) FROM met UNION ALL
        SELECT 'speed', 'Velocidade', avg(speed) FROM met UNION ALL
        SELECT 'sp_attack', 'Esp. Ataque', avg(sp_attack) FROM met) p""",
    "diverse_top_n": _team(10, "type_1"),
    "diverse_top_n_many_types": _team(6, "type_2"),
    "plain_top_n": _team(6, "type_1", diverse=False),
    "clean_entities": "SELECT * FROM cent",
    "split_types_column": """SELECT p_partkey AS entity_id,
        concat(' ', p_type, ' , ', p_brand, '| ', p_name) AS types, p_type AS type_1, p_brand AS type_2 FROM part""",
    "coerce_flags": """SELECT coalesce(lower(trim(legendary)) IN ('true', '1', 'yes', 'y', 't'), false) AS legendary,
        count(*) AS n FROM raw_ent GROUP BY 1""",
    "key_range_filter": "SELECT * FROM ent WHERE entity_id <= 799",
    "numeric_coercion": f"""SELECT name, {_whole('id')} AS id_long, TRY_CAST("Atk" AS DOUBLE) AS attack_double,
        {_plain_int('"Atk"')} AS attack_int, coalesce(TRY_CAST("Atk" AS DOUBLE), 0::DOUBLE) AS attack_filled,
        CAST(trunc("Def") AS INTEGER) AS defense_int FROM raw_ent""",
    "clean_contests": "SELECT * FROM ccon",
    "conform_entities": f"""SELECT entity_id, name, type_1, type_2, generation, legendary, CAST(hp AS INTEGER) AS hp,
        {_plain_int('attack')} AS attack, CAST(trunc(defense) AS INTEGER) AS defense, sp_attack, sp_defense,
        CAST(NULL AS INTEGER) AS speed FROM cent WHERE entity_id IS NOT NULL AND name IS NOT NULL""",
    "entities_upsert": """SELECT * FROM new_ent UNION ALL
        SELECT * FROM old_ent WHERE entity_id NOT IN (SELECT entity_id FROM new_ent)""",
    "entities_upsert_partial": """SELECT coalesce(n.entity_id, o.entity_id) AS entity_id, """ + ", ".join(
        f"coalesce(n.{c}, o.{c}) AS {c}" for c in list(bridge.ENTITIES)[1:]
    ) + " FROM old_ent o FULL JOIN new_ent n ON o.entity_id = n.entity_id",
    "new_entities": "SELECT * FROM new_ent WHERE entity_id NOT IN (SELECT entity_id FROM old_ent)",
    "existing_ids": "SELECT entity_id FROM old_ent WHERE entity_id IN (SELECT entity_id FROM new_ent)",
    "last_per_key": """SELECT * EXCLUDE (rn) FROM (SELECT l_partkey AS entity_id, l_orderkey AS seq,
        l_quantity AS hp, row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC, l_orderkey DESC,
        l_quantity DESC) AS rn FROM lineitem) t WHERE rn = 1""",
    "entity_load_report": f"""SELECT max(n) AS raw, max(bad) AS out_of_range, max(n - bad) - count(k) AS unnamed,
        count(k) - count(DISTINCT k) AS source_duplicates,
        count(DISTINCT CASE WHEN k NOT IN (SELECT entity_id FROM old_ent) THEN k END) AS inserted,
        count(DISTINCT CASE WHEN k IN (SELECT entity_id FROM old_ent) THEN k END) AS updated
        FROM (SELECT CASE WHEN name IS NOT NULL THEN {_whole('id')} END AS k, count(*) OVER () AS n,
            count(*) FILTER ({_whole('id')} IS NULL) OVER () AS bad FROM raw_ent) r""",
    "delete_by_key": "SELECT * FROM ent WHERE entity_id NOT IN (SELECT entity_id FROM new_ent)",
    "contests_dedup": "SELECT DISTINCT first_id, second_id, winner_id FROM con",
    "contests_fk_filter": """SELECT * FROM con WHERE first_id IN (SELECT entity_id FROM old_ent)
        AND second_id IN (SELECT entity_id FROM old_ent) AND winner_id IN (SELECT entity_id FROM old_ent)""",
    "contests_fk_filter_hot": """SELECT * FROM hot_con WHERE first_id IN (SELECT entity_id FROM old_ent)
        AND second_id IN (SELECT entity_id FROM old_ent) AND winner_id IN (SELECT entity_id FROM old_ent)""",
    "existing_contests": "SELECT * FROM old_con INTERSECT SELECT * FROM con",
    "contests_append": """SELECT DISTINCT * FROM ccon WHERE first_id IN (SELECT entity_id FROM ent)
        AND second_id IN (SELECT entity_id FROM ent) AND winner_id IN (SELECT entity_id FROM ent)
        EXCEPT SELECT * FROM old_con""",
    "unknown_ids": """SELECT DISTINCT id AS entity_id FROM (SELECT first_id AS id FROM ccon UNION ALL
        SELECT second_id FROM ccon UNION ALL SELECT winner_id FROM ccon) u
        WHERE id IS NOT NULL AND id NOT IN (SELECT entity_id FROM old_ent)""",
    "contests_classified": "SELECT first_id, second_id, winner_id, copies, status FROM classified",
    "contest_load_report": """SELECT sum(copies)::BIGINT AS raw,
        coalesce(sum(copies) FILTER (status = 'out_of_range'), 0)::BIGINT AS out_of_range,
        coalesce(sum(copies) FILTER (status = 'unknown_entity'), 0)::BIGINT AS unknown_entity,
        coalesce(sum(copies - 1) FILTER (status IN ('present', 'new')), 0)::BIGINT AS source_duplicates,
        count(*) FILTER (status IN ('present', 'new')) AS unique_valid,
        count(*) FILTER (status = 'present') AS already_present,
        count(*) FILTER (status = 'new') AS inserted FROM classified""",
    "paged_ingest": "SELECT * FROM landed",
    "paged_ingest_limited": "SELECT page, pos, entity_id, hp FROM landed ORDER BY page, pos LIMIT 500",
    "paged_contests_half": """SELECT l_orderkey AS page, CAST(0 AS INTEGER) AS pos, first_id::VARCHAR AS first_id, second_id::VARCHAR AS second_id,
        winner_id::VARCHAR AS winner_id FROM (SELECT l_orderkey, """
    + ", ".join(f"{text} AS {name}" for name, text in bridge.CONTESTS.items())
    + """ FROM lineitem) t ORDER BY page, pos, first_id, second_id, winner_id LIMIT (SELECT count(*) // 2 FROM lineitem)""",
    "paged_contests": "SELECT * FROM con",
    "quarantined_records": """SELECT p_partkey AS page, CAST(1 AS INTEGER) AS pos, 'record is not an object' AS reason,
        CASE WHEN p_size >= 49 THEN 'null' ELSE '3' END AS text FROM part WHERE p_size >= 49 OR (p_size > 25 AND p_size <= 30)
        UNION ALL SELECT p_partkey, NULL, 'no record list in page',
        CASE WHEN p_size = 47 THEN '{"results":[' ELSE '{"detail":"not found"}' END FROM part WHERE p_size BETWEEN 45 AND 47""",
    "detail_fetch": """SELECT page, pos, entity_id, hp FROM landed
        WHERE entity_id IN (SELECT CAST(entity_id AS VARCHAR) FROM old_ent)""",
    "detail_misses": """SELECT entity_id FROM ent
        WHERE CAST(entity_id AS VARCHAR) NOT IN (SELECT entity_id FROM landed)""",
    "detail_fallback": """SELECT entity_id, 'details' AS origin FROM landed
        WHERE entity_id IN (SELECT CAST(entity_id AS VARCHAR) FROM ent)
        UNION ALL SELECT '-1' || CAST(entity_id AS VARCHAR), 'listing' FROM ent""",
    "table_scan": "SELECT p_partkey, p_size FROM part WHERE p_size > 10",
    "flag_default": "SELECT entity_id, false AS legendary FROM ent",
    "paged_ingest_repeated_keys": """SELECT p_partkey AS page, CAST(0 AS INTEGER) AS pos, CAST(p_partkey AS VARCHAR) AS entity_id,
        p_name AS name, CAST(p_size AS INTEGER) AS hp FROM part
        UNION ALL SELECT p_partkey, 1, CAST(p_partkey AS VARCHAR), NULL, CAST(p_size + 1 AS INTEGER) FROM part""",
    "quarantined_whole_texts": """SELECT page, text, left(text, 500) || CASE WHEN length(text) > 500 THEN '...' ELSE '' END AS preview,
        CAST(length(text) AS INTEGER) AS n_chars FROM (SELECT p_partkey AS page,
        '{"detail":"' || repeat(p_name, 100) || '"}' AS text FROM part) t""",
    "quality_report_of_empty": "SELECT *, 7 AS line FROM ("
    + _quality(
        "(SELECT count(*) FROM ent WHERE entity_id IS NULL)",
        "(SELECT count(*) - count(DISTINCT entity_id) FROM ent)", "con7", "seven_met",
    )
    + ") q",
    "quality_report": _quality(
        "(SELECT count(*) FROM ent WHERE entity_id IS NULL)",
        "(SELECT count(*) - count(DISTINCT entity_id) FROM ent)", "con", "met",
    ),
    "quality_report_raw": _quality(
        "(SELECT 2 * count(*) FROM cent WHERE entity_id IS NULL)",
        """(SELECT 2 * count(*) - count(DISTINCT entity_id) - max(CASE WHEN entity_id IS NULL THEN 1 ELSE 0 END) FROM cent)""",
        "ccon", "(SELECT m.* FROM raw_met m SEMI JOIN cent c ON m.entity_id = c.entity_id) q",
    ),
    "kpi_summary": """SELECT (SELECT count(*) FROM ent) AS total_entities, (SELECT count(*) FROM con) AS total_contests,
        (SELECT count(winner_id) FROM con) AS total_victories, label AS top_attribute, r AS top_attribute_r,
        printf('%.2f', r) AS top_attribute_r_text FROM infl WHERE position = 1""",
    "top_attribute": "SELECT label, r FROM infl WHERE position = 1",
    "influence": "SELECT * FROM infl",
    "influence_extremes": """SELECT u.role, stat, label, r, printf('%.2f', r) AS r_text FROM infl,
        (VALUES ('most'), ('second'), ('least')) u(role) WHERE (u.role = 'most' AND position = 1)
        OR (u.role = 'second' AND position = least(2, ranked)) OR (u.role = 'least' AND position_from_least = 1)""",
    "influence_table": "SELECT position, label, round_even(strength * 100, 0) / 100 AS correlation FROM infl",
    "top_correlations": """SELECT position, stat, label, r, printf('%.3f', r) AS r_text, direction
        FROM infl WHERE position <= 3""",
    "correlation_bars": "SELECT label, strength, r, printf('%.2f', r) AS r_text, tier FROM infl",
    "win_rate_by_type": "SELECT type, name, total_wins, total_battles, win_rate_pct FROM by_type WHERE position = 1",
    "top_cards": f"""SELECT position, name, win_rate_pct, {_CARD} AS win_rate_text,
        CASE WHEN win_rate_pct >= 95 THEN 'very high' WHEN win_rate_pct >= 90 THEN 'high'
        WHEN win_rate_pct >= 85 THEN 'medium' ELSE 'low' END AS tier
        FROM by_type WHERE position <= 5 AND type = 'ECONOMY'""",
    "team_cards": _team_cards(6),
    "team_cards_ten": _team_cards(10),
    "diagnostics": """SELECT position, name, type, total_wins, total_battles, win_rate_pct FROM by_type
        WHERE position <= 10 AND type = 'ECONOMY'""",
    "diagnostic_message": """SELECT 'Top do tipo = ' || name || ' com ' || total_wins || '.0/' || total_battles || '.0 = '
        || printf('%.2f', win_rate_pct) || '%' AS message FROM by_type WHERE position = 1 AND type = 'ECONOMY'""",
    "win_rate_table": """SELECT type AS "Tipo", name AS "Pokémon", total_wins AS "Vitórias", total_battles AS "Batalhas",
        printf('%.2f', win_rate_pct) || '%' AS "Win Rate (%)" FROM by_type WHERE position = 1""",
    "load_job": "SELECT * FROM job_met",
    "load_job_quarantine": """SELECT 'listing' AS source, p_partkey AS page, CAST(1 AS INTEGER) AS pos, 'record is not an object' AS reason,
        CAST(CASE WHEN p_size >= 49 THEN 4 ELSE 1 END AS INTEGER) AS n_chars FROM part WHERE p_size >= 49 OR (p_size > 25 AND p_size <= 30)
        UNION ALL SELECT 'listing', p_partkey, NULL, 'no record list in page', CASE WHEN p_size = 47 THEN 12 ELSE 22 END
        FROM part WHERE p_size BETWEEN 45 AND 47
        UNION ALL SELECT 'contests', p_partkey, NULL, 'no record list in page', 13 + 100 * length(p_name) FROM part
        UNION ALL SELECT 'entities', p_partkey, 0, 'entity without a name',
            length('{"page":,"pos":0,"entity_id":2000000000,"hp":,"legendary":false}') - 10
            + length(CAST(p_partkey AS VARCHAR)) + length(CAST(p_partkey + 2000000000 AS VARCHAR)) + length(CAST(p_size AS VARCHAR)) FROM part""",
    "contests_batch_load": "SELECT * FROM con UNION SELECT * FROM old_con WHERE first_id <= 33",
    "entities_load_ranges": """SELECT * FROM new_ent UNION ALL
        SELECT * FROM old_ent WHERE entity_id NOT IN (SELECT entity_id FROM new_ent)""",
    "metrics_after_loads": "SELECT * FROM two_met",
    "contests_deleted": """SELECT *, 'deleted' AS step FROM left_con UNION ALL SELECT *, 'compacted' FROM left_con
        UNION ALL SELECT 2 * count(*), count(*), 0, 'totals' FROM left_con""",
    "entities_deleted": """SELECT * FROM old_ent WHERE entity_id IN (SELECT first_id FROM idle_con UNION ALL
        SELECT second_id FROM idle_con UNION ALL SELECT winner_id FROM idle_con)""",
    "stream_late_entities": "SELECT DISTINCT first_id, second_id, winner_id FROM con",
    "stream_load_job": "SELECT DISTINCT first_id, second_id, winner_id FROM con",
}

ORACLE_SQL = {name: BASE + body for name, body in BODIES.items()}
