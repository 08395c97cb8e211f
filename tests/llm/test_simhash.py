"""SimHash against plain Python: fingerprints, all pairs of distinct fingerprints, and components."""

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from duelframe.llm import components as comp
from duelframe.llm import simhash
from duelframe.llm.common import ship
from tests.llm.rows import ROWS, SCHEMA, edges, nothing

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    found = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64(x.encode(), seed=42).intdigest() for x in found]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_roots(nodes, near):
    """node: smallest node it is joined to, by every pair."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a in nodes:
        for b in nodes:
            if a < b and near(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def close(a, b):
    return ((a ^ b) & (1 << 64) - 1).bit_count() <= 2


def plain(rows):
    bits = [plain_fingerprint(r[1]) for r in rows]
    roots = plain_roots(sorted(set(bits)), close)
    ids = {}
    for row, b in zip(rows, bits, strict=True):
        ids.setdefault(roots[b], []).append(row[0])
    least = {r: min((x for x in found if x is not None), default=None) for r, found in ids.items()}
    return sorted(((row[0], f"{b:016x}", least[roots[b]]) for row, b in zip(rows, bits, strict=True)), key=repr)


def found(frame):
    ship(frame.sparkSession)
    got = simhash.near_duplicates(frame).select("doc_id", simhash.as_text(F.col("bits")), "component_id")
    return sorted((tuple(r) for r in got.collect()), key=repr)


@pytest.mark.parametrize("text", ["", "one", "One TWO", "a b c", "a b c d", "É é ß\x85x y z", "\x0b\x0ctab\tnew\nline", "w " * 300, "x" * 5000])
def test_fingerprints(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_fingerprint_of_a_long_text():
    draw = random.Random(1)
    text = " ".join(draw.choice(["alpha", "Beta", "gamma", "delta"]) + str(draw.randint(0, 50)) for _ in range(70_000))
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_spark_hashes_alike(spark):
    row = spark.sql("SELECT xxhash64('a b c') AS h").first()
    assert row["h"] & (1 << 64) - 1 == xxhash.xxh64(b"a b c", seed=42).intdigest()


def texts(n, seed):
    """Long texts with copies that differ in a word or two, so that fingerprints are near, and short ones."""
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(500)]
    base = [[draw.choice(words) for _ in range(400)] for _ in range(6)]
    out = []
    for i in range(n):
        text = list(draw.choice(base))
        for _ in range(draw.choice([0, 1, 1, 2, 3])):
            text[draw.randrange(len(text))] = draw.choice(words)
        out.append((i * 3 - 40, " ".join(text[: draw.choice([400, 400, 400, 5])]), "en", "a", 1))
    return out


def test_components_are_those_of_all_pairs(spark):
    rows = texts(300, 2)
    want = plain(rows)
    assert 10 < len({r[2] for r in want}) < len({r[1] for r in want}) - 20  # chains of several texts
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(4)) == want


def test_edges(spark):
    assert found(edges(spark)) == plain(ROWS)
    frame = edges(spark).withColumns({c: F.lit("clash") for c in ("bits", "component_id", "choice", "block", "n", "first_id", "u", "v", "a", "b")})
    assert found(frame) == plain(ROWS)
    assert found(nothing(spark)) == []
    assert found(spark.createDataFrame([(None, "a b c d", "en", "a", 1)] * 2, SCHEMA)) == [(None, f"{plain_fingerprint('a b c d'):016x}", None)] * 2


def numbers(count, seed):
    """Fingerprints around few centres, so that files are large, and any others."""
    draw = random.Random(seed)
    centres = [draw.getrandbits(64) for _ in range(3)]
    out = set()
    while len(out) < count:
        x = draw.choice(centres) if draw.random() < 0.9 else draw.getrandbits(64)
        for _ in range(draw.choice([0, 1, 2, 3, 5])):
            x ^= 1 << draw.randrange(64)
        out.add(simhash._number(x))
    return sorted(out)


@pytest.mark.parametrize("most", [4, 64, 10_000])
def test_files_of_any_size_lose_no_link(spark, monkeypatch, most):
    monkeypatch.setattr(simhash, "MOST", most)
    nodes = numbers(500, 3)
    frame = spark.createDataFrame([(x,) for x in nodes], "bits long")
    joined = simhash.links(frame)
    assert all(close(r["a"], r["b"]) for r in joined.collect())
    ship(spark)
    got = {r["node"]: r["root"] for r in comp.components(joined).collect()}
    want = plain_roots(nodes, close)
    assert got == {n: r for n, r in want.items() if n != r} and len(got) > 100


def test_masks_leave_out_every_two_blocks():
    found = [m & (1 << 64) - 1 for m in simhash.masks()]
    assert len(found) == 10 and all(m.bit_count() in (38, 39) for m in found)
    for i in range(64):
        for j in range(i):
            assert any(not m >> i & 1 and not m >> j & 1 for m in found)


@pytest.mark.parametrize("shape", ["path", "rising", "star", "hub", "random", "none"])
def test_components_of_any_shape(spark, monkeypatch, shape):
    monkeypatch.setattr(comp, "HOT_ROWS", 20)
    monkeypatch.setattr(comp, "PIECE", 50)
    draw = random.Random(5)
    names = draw.sample(range(-10_000, 10_000), 600)
    pairs = {
        "path": list(zip(names, names[1:], strict=False)),
        "rising": list(zip(sorted(names), sorted(names)[1:], strict=False)),
        "star": [(min(names), x) for x in names],
        "hub": [(max(names), x) for x in names[:300]] + [(sorted(names)[300], x) for x in names[200:]],
        "random": [(draw.choice(names), draw.choice(names)) for _ in range(500)],
        "none": [],
    }[shape]
    ship(spark)
    frame = spark.createDataFrame(pairs, "a long, b long").repartition(7)
    got = {r["node"]: r["root"] for r in comp.components(frame).collect()}
    linked = set(pairs) | {(b, a) for a, b in pairs}
    assert got == {n: r for n, r in plain_roots(sorted({x for p in pairs for x in p}), lambda a, b: (a, b) in linked).items() if n != r}


def test_hot_keys_meet_in_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(comp, "HOT_ROWS", 50)
    rows = spark.range(1000).select(F.when(F.col("id") < 400, F.lit(-1)).otherwise(F.col("id") % 100).alias("k"), "id")
    counts = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    joined = comp.join_counted(rows, counts, ["k"])
    assert sorted((r["id"], r["n"]) for r in joined.collect()) == sorted((r["id"], r["n"]) for r in rows.join(counts, "k").collect())
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()
