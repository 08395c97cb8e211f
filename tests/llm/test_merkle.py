"""Merkle manifest and proofs against a plain tree in Python."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from duelframe.llm import merkle
from tests.llm.rows import ROWS, SCHEMA, edges, nothing

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(doc_id, text, lang, source, n_chars):
    return sha(*["-" if x is None else f"{len(str(x).encode())}:{x}" for x in (doc_id, source, lang, n_chars, text)])


def climb(level):
    """Root of a list of digests and each one's segments of siblings, from the leaf up."""
    ways, at = [[] for _ in level], list(range(len(level)))
    while len(level) > 1:
        for i, way in enumerate(ways):
            run = at[i] // 8 * 8
            way.append((level[run : at[i]], level[at[i] + 1 : run + 8]))
        at = [x // 8 for x in at]
        level = [sha(*level[i : i + 8]) for i in range(0, len(level), 8)]
    return (level or [None])[0], ways


def plain(rows):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of each row, sorted."""
    trees = {}
    for row in rows:
        trees.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, plain_leaf(*row), row))
    order = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    made = {lang: climb([x[2] for x in sorted(trees[lang], key=lambda x: x[:3])]) for lang in order}
    root, tops = climb([made[lang][0] for lang in order])
    out = []
    for lang, top in zip(order, tops, strict=True):
        for (_, _, leaf, row), way in zip(sorted(trees[lang], key=lambda x: x[:3]), made[lang][1], strict=True):
            text = row[1]
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and text is not None:
                text = text.translate(LOWER)
            here = plain_leaf(row[0], text, *row[2:])
            for left, right in way + top:
                here = sha(*left, here, *right)
            out.append((row[0], leaf, made[lang][0], root, sha(*[d for left, right in way + top for d in left + right]), here, here == root))
    return sorted(out, key=repr)


def many(n, langs, seed):
    draw = random.Random(seed)
    text = lambda: draw.choice([None, "", "all lower", "Some Capitals", "ÄÖ only", "x" * draw.randint(1, 50)])
    ids = draw.sample(range(-n, 5 * n), n)
    return [(i, text(), draw.choices(langs, [n * n, *[1 + k for k in range(len(langs) - 1)]])[0], draw.choice(["a", None]), draw.choice([None, 7])) for i in ids]


def found(frame):
    return sorted((tuple(r) for r in merkle.verify(frame).collect()), key=repr)


@pytest.mark.parametrize("n, langs", [(1, ["en"]), (2, [None]), (8, ["en"]), (9, ["en", None]), (65, ["en", "de", None, "", "a", "=b"]), (700, ["en", *[f"l{i}" for i in range(40)]])])
def test_digests_and_proofs_are_those_of_a_plain_tree(spark, n, langs):
    rows = many(n, langs, n)
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(4)) == plain(rows)


def test_edges_repeated_rows_and_clashing_names(spark):
    assert found(edges(spark)) == plain(ROWS)
    frame = edges(spark).withColumns({c: F.lit("clash") for c in ("tree", "nth", "leaf", "digest", "children", "path", "total", "height", "changed")})
    assert found(frame) == plain(ROWS)
    assert found(nothing(spark)) == []


def test_equal_runs_share_a_record(spark):
    rows = [(5, "The Same", "en", "a", 1)] * 600 + [(6, "other", "en", "a", 1)]
    assert found(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_lower_levels_meet_in_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BROADCAST", 2)
    rows = many(700, ["en", "de", None, "fr"], 11)
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(4)) == plain(rows)


def test_proofs_of_wanted_leaves_only(spark):
    rows = many(300, ["en", "de", None], 5)
    made = merkle.manifest(spark.createDataFrame(rows, SCHEMA))
    ranks = made.leaves.select("tree", "nth").where("nth % 50 = 3")
    whole = {(r["tree"], r["nth"]): r for r in merkle.proofs(made).collect()}
    some = merkle.proofs(made, ranks).collect()
    assert len(some) == ranks.count() > 3
    assert all(whole[r["tree"], r["nth"]] == r for r in some)
    assert merkle.ways(made, ranks).count() == ranks.count()


def test_query_is_its_sql(spark, small_duck):
    from duelframe.llm.queries import ORACLE_SQL, QUERIES
    from tests.compare import difference
    from tests.conftest import SMALL

    assert difference(spark, small_duck, SMALL, QUERIES["op13_merkle_manifest"], ORACLE_SQL["op13_merkle_manifest"]) is None
