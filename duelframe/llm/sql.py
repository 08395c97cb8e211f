"""Check SQL for DuckDB over the same tables, written apart from the Spark code."""

_RATIOS = """
  SELECT *, 1000 * n_symbols // greatest(n_words, 1) AS symbols, 1000 * n_repeat_words // greatest(n_words, 1) AS repeats,
         1000 * n_dup_lines // greatest(n_words, 1) AS dup_lines, 1000 * n_capitals // greatest(word_chars, 1) AS capitals,
         100 * word_chars // greatest(n_words, 1) AS word_length,
         n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed
  FROM counts"""

_QUANTILES = ", ".join(f"min(edge) FILTER (100 * upto >= {p} * total) AS q{p}" for p in (1, 25, 75, 99))
_LIMITS = """
  SELECT {groups}, max(total) AS total,
         max(q75 + (2 ** greatest(length(bin(q75)) - 6, 0))::BIGINT - 1 + 3 * (q75 - q25) + 20) FILTER (ratio = 'symbols') AS symbols_high, max(tail + 10) FILTER (ratio = 'repeats') AS repeats_high,
         max(tail + 2) FILTER (ratio = 'dup_lines') AS dup_lines_high, max(tail + 5) FILTER (ratio = 'capitals') AS capitals_high,
         max(tail + 10) FILTER (ratio = 'word_length') AS word_length_high, max(head - 10) FILTER (ratio = 'word_length') AS word_length_low
  FROM (SELECT {groups}, ratio, max(total) AS total, {quantiles},
               q99 + (2 ** greatest(length(bin(q99)) - 6, 0))::BIGINT - 1 + (q99 - q75) // 2 AS tail, q1 - (q25 - q1) // 2 AS head
        FROM (SELECT *, sum(n) OVER (PARTITION BY {groups}, ratio ORDER BY edge) AS upto, sum(n) OVER (PARTITION BY {groups}, ratio) AS total
              FROM (SELECT {groups}, ratio, edge, count(*) AS n FROM edges GROUP BY ALL))
        GROUP BY {groups}, ratio)
  GROUP BY {groups}"""

#: A CTE chain that ends in `judged`: one row per document.
RULES_CTE = f"""
docs AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
split AS (SELECT rid, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM docs),
windows AS (SELECT rid, i, array_to_string(words[i : i + 4], chr(1)) AS w FROM (SELECT rid, words, unnest(generate_series(1, len(words) - 4)) AS i FROM split WHERE len(words) > 5)),
repeated AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(generate_series(i, i + 4)) AS p FROM (SELECT *, count(*) OVER (PARTITION BY rid, w) AS c FROM windows) WHERE c > 1) GROUP BY rid),
counts AS (
  SELECT doc_id, lang, source, len(words)::BIGINT AS n_words, length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n, 0)::BIGINT AS n_repeat_words, (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')))::BIGINT AS n_capitals
  FROM docs JOIN split USING (rid) LEFT JOIN repeated USING (rid)),
ratios AS ({_RATIOS}),
edges AS (
  SELECT lang, source, 1 AS everything, ratio, v // (2 ** greatest(length(bin(v)) - 6, 0))::BIGINT * (2 ** greatest(length(bin(v)) - 6, 0))::BIGINT AS edge
  FROM (SELECT lang, source, unnest(['symbols', 'repeats', 'dup_lines', 'capitals', 'word_length']) AS ratio, unnest([symbols, repeats, dup_lines, capitals, word_length]) AS v
        FROM ratios WHERE NOT base_failed)),
fine AS ({_LIMITS.format(groups="lang, source", quantiles=_QUANTILES)}),
middle AS ({_LIMITS.format(groups="lang", quantiles=_QUANTILES)}),
coarse AS ({_LIMITS.format(groups="everything", quantiles=_QUANTILES)}),
judged AS (
  SELECT r.*, NOT base_failed AND NOT coalesce(
      symbols > t.symbols_high OR repeats > t.repeats_high OR dup_lines > t.dup_lines_high OR capitals > t.capitals_high
      OR word_length > t.word_length_high OR word_length < t.word_length_low, false) AS kept
  FROM (SELECT r.*, CASE WHEN f.total >= 200 THEN f ELSE NULL END AS f, CASE WHEN m.total >= 200 THEN m ELSE NULL END AS m, c
        FROM ratios r LEFT JOIN fine f ON r.lang IS NOT DISTINCT FROM f.lang AND r.source IS NOT DISTINCT FROM f.source
        LEFT JOIN middle m ON r.lang IS NOT DISTINCT FROM m.lang LEFT JOIN coarse c ON c.everything = 1) r,
       LATERAL (SELECT {", ".join(f"CASE WHEN r.f IS NOT NULL THEN r.f.{x} WHEN r.m IS NOT NULL THEN r.m.{x} ELSE r.c.{x} END AS {x}" for x in ("symbols_high", "repeats_high", "dup_lines_high", "capitals_high", "word_length_high", "word_length_low"))}) t)"""

#: crc32 of a decimal number as text: a bit at a time for each of its characters.
_CRC32 = "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)), lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, y: xor(x // 2, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END::BIGINT))), 4294967295::BIGINT)"


def _field(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c}::VARCHAR END"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _tree(name: str, below: str, levels: int) -> str:
    """CTEs {name}_0 to {name}_{levels} with the nodes by level, and {name}_run_k with the runs of level k."""
    out = [f"{name}_0 AS (SELECT * FROM {below})"]
    for k in range(levels):
        out.append(f"{name}_run_{k} AS (SELECT tree, nth // 8 AS nth, total, list(digest ORDER BY nth) AS children FROM {name}_{k} GROUP BY tree, nth // 8, total)")
        out.append(f"{name}_{k + 1} AS (SELECT tree, nth, ceil(total / 8)::BIGINT AS total, CASE WHEN total = 1 THEN children[1] ELSE sha256(array_to_string(children, '')) END AS digest FROM {name}_run_{k})")
    return ",\n".join(out)


def _climb(name: str, start: str, levels: int) -> str:
    """CTEs {name}_up_0 to {name}_up_{levels}: (row, tree, at, folded, proof) after so many levels, from `start`."""
    out = [f"{name}_up_0 AS ({start})"]
    for k in range(levels):
        left, right = "array_to_string(r.children[1:u.at % 8], '')", "array_to_string(r.children[u.at % 8 + 2:], '')"
        out.append(
            f"{name}_up_{k + 1} AS (SELECT u.row, u.tree, u.at // 8 AS at, CASE WHEN r.total = 1 THEN u.folded ELSE sha256({left} || u.folded || {right}) END AS folded,"
            f" CASE WHEN r.total = 1 THEN u.proof ELSE u.proof || {left} || {right} END AS proof FROM {name}_up_{k} u JOIN {name}_run_{k} r ON u.tree = r.tree AND u.at // 8 = r.nth)"
        )
    return ",\n".join(out)


#: Trees of up to 8 ** 7 documents a language and 8 ** 4 languages.
_DEEP, _WIDE = 7, 4
MERKLE_SQL = f"""
WITH base AS (SELECT row_number() OVER () AS row, doc_id, coalesce('=' || lang, '') AS tree, {_leaf("text")} AS leaf,
    CASE WHEN {_CRC32} % 3 = 0 THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} ELSE leaf END AS changed FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS nth, count(*) OVER (PARTITION BY tree) AS total FROM base),
{_tree("t", "(SELECT tree, nth, total, leaf AS digest FROM placed)", _DEEP)},
subroots AS (SELECT tree AS lang, digest, row_number() OVER (ORDER BY tree) - 1 AS nth, count(*) OVER () AS total FROM t_{_DEEP}),
{_tree("s", "(SELECT 0 AS tree, nth, total, digest FROM subroots)", _WIDE)},
{_climb("t", "SELECT row, tree, nth AS at, changed AS folded, '' AS proof FROM placed", _DEEP)},
{_climb("s", f"SELECT u.row, 0 AS tree, r.nth AS at, u.folded, u.proof FROM t_up_{_DEEP} u JOIN subroots r ON u.tree = r.lang", _WIDE)}
SELECT p.doc_id, p.leaf, r.digest AS subroot, s.digest AS root, sha256(u.proof) AS proof_sha256, u.folded AS folded_root, u.folded = s.digest AS verified
FROM placed p JOIN s_up_{_WIDE} u ON p.row = u.row JOIN subroots r ON p.tree = r.lang, s_{_WIDE} s"""

#: All anchors against all rows.
NEGATIVES_SQL = """
WITH v AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (SELECT a.vec_id AS anchor_id, a.label AS anchor_label, b.vec_id AS id, b.label AS label, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (SELECT anchor_id, anchor_label, id AS positive_id, score AS positive_score FROM pairs WHERE label = anchor_label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.positive_id, row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.id)::INTEGER AS rank,
  n.id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND n.label <> p.anchor_label AND 80 * p.positive_score <= 100 * n.score AND 100 * n.score <= 100 * p.positive_score
QUALIFY rank <= 5"""

ORACLE_SQL = {
    "op5_adaptive_rules": f"WITH {RULES_CTE} SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM judged",
    "op12_hard_negatives": NEGATIVES_SQL,
    "op13_merkle_manifest": MERKLE_SQL,
}
