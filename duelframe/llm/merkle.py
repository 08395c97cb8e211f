"""Merkle manifest of a data set: a content-addressed store of tree nodes, and proofs by descent from the root.

Every document is a leaf. The leaves of a language, in the order of their ids, are joined by eights, level by
level, until one digest is left: the language's root. The languages' roots are joined the same way to the root
of the data set. The store has one record per distinct node: its digest and its children's.

A proof lists the siblings on the way from a leaf to the root. Requests for leaves start at the root and go
down by the digits of the leaf's rank to base eight: each record that a digest leads to gives the child that
the digit names and, beside it, the children that were not selected. Requests with the same digits so far go
down as one, so a level has as many rows as nodes on the requested ways, and only the last step has a row per
leaf. On the way down segments are collected from the root; reversed, they are the proof.

Only DataFrame functions are used.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelframe.llm.common import shared_folder, stored, tables_stored
from duelframe.operators.positions import with_positions

FAN = 8
#: Fields of a leaf, in their order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PATH = "array<struct<left:string,right:string>>"
#: Records of one height that are broadcast on the way down: some 700 bytes each. Lower levels are joined by shuffles.
BROADCAST = 4096


@dataclass(frozen=True)
class Level:
    """The records of one height: digest, children. A digest occurs once."""

    records: DataFrame
    n: int


@dataclass(frozen=True)
class Manifest:
    """The store and what leads into it."""

    #: doc_id, tree, leaf, changed, nth: every document's leaf and its rank in its tree.
    leaves: DataFrame
    #: tree, nth, digest, height: the root of each language's tree and its place among them.
    subroots: DataFrame
    #: One row, none for an empty data set: digest, height.
    root: DataFrame
    #: By height from 1: nodes of the languages' trees, and of the tree that joins their roots.
    below: tuple[Level, ...]
    above: tuple[Level, ...]


def digest(c: Column) -> Column:
    """Lowercase hex SHA-256 of a text's UTF-8 bytes."""
    return F.sha2(c.cast("binary"), 256)


def field(c: Column) -> Column:
    """A value for hashing: `-` if null, else its length in bytes, a colon and the value."""
    text = c.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(**instead: Column) -> Column:
    """The digest of a document; `instead` has other values for its fields."""
    return digest(F.concat(*[field(instead.get(name, F.col(name))) for name in FIELDS]))


def tampered(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def leaves(documents: DataFrame) -> DataFrame:
    """doc_id, tree (the language as a key), leaf, changed (the leaf of a tampered row, else null), nth and total (rows of the tree)."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    changed = F.when(crc % 3 == 0, leaf(text=tampered(F.col("text"))))
    tree = F.coalesce(F.concat(F.lit("="), "lang"), F.lit(""))  # in the order of the languages, null first
    hashed = documents.select("doc_id", tree.alias("tree"), leaf().alias("leaf"), changed.alias("changed"))
    hashed = stored(hashed, "leaves")  # ranges are found by a pass of their own, which is not to read the texts again
    return _ranked(hashed, [F.col("doc_id").asc_nulls_first(), F.col("leaf")], ["tree"])


def _ranked(frame: DataFrame, order: list[Column], by: list[str]) -> DataFrame:
    folder = f"{shared_folder(frame.sparkSession)}/llm-{uuid.uuid4().hex}"
    tables_stored(frame.sparkSession).append(folder)
    return with_positions(frame, order, f"{folder}/ranked", name="nth", by=by, total="total").withColumn("nth", F.col("nth") - 1)


def forest(nodes: DataFrame) -> tuple[DataFrame, tuple[Level, ...]]:
    """Root of each tree (tree, digest, height) and the levels of all trees over `nodes` (tree, nth, total, digest).

    A node's `total`, the nodes beside it in its tree's level, says when a tree has come to one node, so no level
    has to be counted by tree. A level is an eighth of the one below.
    """
    roots, levels = None, []
    while True:
        single = nodes.where("total = 1").select("tree", "digest", F.lit(len(levels)).alias("height"))
        roots = single if roots is None else roots.unionByName(single)
        run = F.floor(F.col("nth") / FAN).alias("nth")
        total = F.ceil(F.col("total") / FAN).alias("total")
        joined = nodes.where("total > 1").groupBy("tree", total, run).agg(F.array_sort(F.collect_list(F.struct(nodes["nth"], "digest")))["digest"].alias("children"))
        level = stored(joined.withColumn("digest", digest(F.array_join("children", ""))), f"level-{len(levels) + 1}")
        n = level.count()
        if not n:
            return stored(roots, "roots"), tuple(levels)
        levels.append(Level(level.select("digest", "children").dropDuplicates(["digest"]), n))
        nodes = level.select("tree", "nth", "total", "digest")


def manifest(documents: DataFrame) -> Manifest:
    """The store of `documents` (doc_id, source, lang, n_chars, text). Other columns are not read.

    Nulls have a form of their own in the hash and a null language a tree of its own, the first. Rows of one id are in
    the order of their leaves, and equal rows are a leaf each; null ids come first. No documents have no root.
    """
    placed = leaves(documents)
    roots, below = forest(placed.select("tree", "nth", "total", F.col("leaf").alias("digest")))
    subroots = stored(_ranked(roots, [F.col("tree")], []), "subroots")
    top, above = forest(subroots.select(F.lit("").alias("tree"), "nth", "total", "digest"))
    return Manifest(placed.drop("total"), subroots.drop("total"), top.select("digest", "height"), below, above)


def _beside(children: Column, at: Column) -> Column:
    """The children that were not selected, as a segment of the path."""
    left, right = F.slice(children, F.lit(1), at), F.slice(children, at + 2, F.lit(FAN))
    return F.struct(F.array_join(left, "").alias("left"), F.array_join(right, "").alias("right"))


def _looked_up(requests: DataFrame, level: Level) -> DataFrame:
    """The requests with the children of their digest. Few records are broadcast, many meet them in a shuffle."""
    records = F.broadcast(level.records) if level.n <= BROADCAST else level.records.hint("merge")
    return (requests if level.n <= BROADCAST else requests.hint("merge")).join(records, "digest")


def _down(requests: DataFrame, level: Level) -> DataFrame:
    """One step down: a request per child, with its digit appended to the rank and the others to the path."""
    found = _looked_up(requests, level)
    kept = [c for c in requests.columns if c not in ("digest", "nth", "path")]
    step = found.select(*kept, "nth", "path", "children", F.posexplode("children").alias("digit", "digest"))
    path = F.concat("path", F.array(_beside(F.col("children"), F.col("digit"))))
    return step.select(*kept, "digest", (F.col("nth") * FAN + F.col("digit")).alias("nth"), path.alias("path"))


def _wanted(requests: DataFrame, ranks: DataFrame | None, height: int) -> DataFrame:
    """Those on the way to a wanted leaf (tree, nth)."""
    if ranks is None:
        return requests
    digits = ranks.select("tree", F.floor(F.col("nth") / FAN**height).alias("nth")).distinct()
    return requests.join(digits, ["tree", "nth"], "left_semi")


def ways(made: Manifest, ranks: DataFrame | None = None) -> DataFrame:
    """tree, run, subroot, root, path and children for each run of eight leaves, or for those with wanted `ranks` (tree, nth).

    `path` has the segments from the root down to the run; `children` are the run's leaves, null for a tree of one leaf.
    """
    at = made.root.select(F.col("digest").alias("root"), "digest", F.lit(0).cast("bigint").alias("nth"), F.array().cast(_PATH).alias("path"))
    for level in reversed(made.above):
        at = _down(at, level)
    entered = at.withColumnRenamed("digest", "subroot").join(made.subroots.select("nth", "tree", "digest", "height"), "nth")
    entered = entered.select("root", "subroot", "tree", "digest", F.lit(0).cast("bigint").alias("nth"), "path", "height")
    if ranks is not None:
        entered = entered.join(ranks.select("tree").distinct(), "tree", "left_semi")
    entered = stored(entered, "entered")
    runs, at = entered.where("height = 0").withColumn("children", F.lit(None).cast("array<string>")).drop("height"), None
    for height in range(len(made.below), 0, -1):
        here = entered.where(F.col("height") == height).drop("height")
        at = here if at is None else at.unionByName(here)
        level = made.below[height - 1]
        if height == 1:
            runs = runs.unionByName(_wanted(_looked_up(at, level), ranks, 1))
        else:
            at = _wanted(_down(at, level), ranks, height - 1)
    return runs.withColumnRenamed("nth", "run").drop("digest")


def proofs(made: Manifest, ranks: DataFrame | None = None) -> DataFrame:
    """doc_id, tree, nth, leaf, changed, subroot, root, path: per leaf, or per wanted one, the way up to the root.

    `path` has a segment per level from the leaf up: the digests of the siblings to the left, and to the right.
    """
    asked = made.leaves if ranks is None else made.leaves.join(ranks.select("tree", "nth").distinct(), ["tree", "nth"], "left_semi")
    asked = asked.withColumn("run", F.floor(F.col("nth") / FAN))
    runs = ways(made, ranks)
    found = asked.hint("merge").join(runs.hint("merge"), ["tree", "run"])
    digit = F.pmod("nth", F.lit(FAN)).cast("int")
    last = F.when(F.col("children").isNull(), F.array().cast(_PATH)).otherwise(F.array(_beside(F.col("children"), digit)))
    path = F.reverse(F.concat("path", last))
    return found.select("doc_id", "tree", "nth", "leaf", "changed", "subroot", "root", path.alias("path"))


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its way give."""
    return F.aggregate(path, start, lambda d, s: digest(F.concat(s["left"], d, s["right"])))


def siblings(path: Column) -> Column:
    """All digests of a proof, from the leaf up and from left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def verify(documents: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified for every row of `documents`.

    The proof is that of the untampered row; where crc32 of the id is divisible by 3, `folded_root` starts from
    the row with its text in lower case, which is not verified unless the text had no capital. Nulls, repeated rows
    and empty tables as `manifest` says; a null id is never tampered with.
    """
    proved = proofs(manifest(documents))
    again = folded(F.coalesce("changed", "leaf"), F.col("path"))
    found = proved.select("doc_id", "leaf", "subroot", "root", digest(siblings(F.col("path"))).alias("proof_sha256"), again.alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
