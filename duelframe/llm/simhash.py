"""SimHash fingerprints, and classes of documents whose fingerprints differ in two bits at most.

A fingerprint's 64 bits are parted into five blocks. Two fingerprints that differ in two bits agree in three blocks
at least, so each is filed under its ten choices of three blocks, and those of one file are compared. A file of up
to MOST fingerprints is compared pair by pair. Larger files, such as those of many near copies of one text, would
take the square of their size; their fingerprints are filed once more, under all 65 fingerprints that differ in one
bit at most. Two that differ in two bits or less, and only those, meet there, 65 at most in a file, and a link to
the smallest of them joins them. Equal fingerprints are one from the start.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelframe.llm.common import stored, texts_of
from duelframe.llm.components import components, join_counted

BITS, WORDS, SEED = 64, 3, 42
#: Differing bits up to which fingerprints are linked.
DISTANCE = 2
#: Widths of the blocks, from the lowest bit up.
BLOCKS = (13, 13, 13, 13, 12)
#: Fingerprints of a file that are compared pair by pair; beyond it the 65 neighbours of each are fewer.
MOST = 64
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_PIECE = 1 << 16


def shingles(text: str) -> list[bytes]:
    """The text's three-word shingles in their order, words parted by ASCII white space and A-Z lowered; all words if fewer, none if none."""
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if len(words) <= WORDS:
        return [b" ".join(words)] if words else []
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-WORDS] + 1])
    return [joined[i:j] for i, j in zip(starts.tolist(), ends[WORDS - 1 :].tolist(), strict=True)]


def fingerprint(text: str) -> int:
    """The bits that are set in over half of the hashes of the text's shingles."""
    found = shingles(text)
    hashes = np.fromiter((xxhash.xxh64_intdigest(x, SEED) for x in found), "<u8", len(found))
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), _PIECE):
        part = hashes[at : at + _PIECE].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes), bitorder="little").tobytes(), "little")


def signed(documents: DataFrame) -> DataFrame:
    """doc_id and bits, the fingerprint as a 64-bit number with sign."""
    kind = documents.schema["doc_id"].dataType.simpleString()

    def sign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            bits = np.array([fingerprint(x) for x in texts_of(frame["text"])], np.uint64).view(np.int64)
            yield pd.DataFrame({"doc_id": frame["doc_id"], "bits": bits})

    return documents.select("doc_id", "text").mapInPandas(sign, f"doc_id {kind}, bits long")


def _number(n: int) -> int:
    return n - (1 << BITS) if n >> (BITS - 1) else n


def masks(blocks: tuple[int, ...] = BLOCKS, distance: int = DISTANCE) -> list[int]:
    """For each choice of all blocks but `distance`: the bits of the chosen ones."""
    starts = [sum(blocks[:i]) for i in range(len(blocks))]
    each = [((1 << width) - 1) << start for start, width in zip(starts, blocks, strict=True)]
    return [_number(sum(chosen)) for chosen in combinations(each, len(blocks) - distance)]


def _differing(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def links(nodes: DataFrame) -> DataFrame:
    """Links (a, b) between the distinct `bits` of `nodes` that join all that differ in DISTANCE bits or less, and no others."""
    filed = F.explode(F.array(*[F.struct(F.lit(i).alias("choice"), F.col("bits").bitwiseAND(F.lit(m)).alias("block")) for i, m in enumerate(masks())]))
    rows = nodes.select("bits", filed.alias("file")).select("bits", "file.*")
    sizes = stored(rows.groupBy("choice", "block").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "sizes")
    members = stored(join_counted(rows, sizes, ["choice", "block"]), "members")
    few = members.where(F.col("n") <= MOST)
    a, b = (few.select("choice", "block", F.col("bits").alias(x)).hint("merge") for x in "ab")
    pairs = a.join(b, ["choice", "block"]).where((F.col("a") < F.col("b")) & (_differing("a", "b") <= DISTANCE)).select("a", "b")
    one_off = F.explode(F.array(F.col("bits"), *[F.col("bits").bitwiseXOR(F.lit(_number(1 << i))) for i in range(BITS)]))
    near = members.where(F.col("n") > MOST).select("bits").distinct().select("bits", one_off.alias("at"))
    met = near.groupBy("at").agg(F.collect_list("bits").alias("all")).where(F.size("all") > 1)  # 65 at most
    stars = met.select(F.explode("all").alias("a"), F.array_min("all").alias("b")).where("a <> b")
    return stored(pairs.unionByName(stars), "links")


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, bits and component_id (the smallest doc_id of its component) per row of `documents`.

    A null text is an empty one; texts without a word have fingerprint zero, linked like any other. Repeated rows stay
    rows of their component. Null ids are no component's smallest unless it has no other. Other columns are not read.
    """
    found = stored(signed(documents), "signed")
    nodes = stored(found.groupBy("bits").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n")), "nodes")
    joined = components(links(nodes))
    joined = stored(joined.unionByName(joined.select(F.col("root").alias("node"), "root").distinct()).withColumnRenamed("node", "bits"), "joined")
    first = joined.hint("merge").join(nodes.select("bits", "first_id").hint("merge"), "bits").groupBy("root").agg(F.min("first_id").alias("component_id"), F.count(F.lit(1)).alias("n"))
    placed = join_counted(joined, stored(first, "first"), ["root"]).select("bits", "component_id")
    placed = nodes.hint("merge").join(placed.hint("merge"), "bits", "left").select("bits", F.coalesce("component_id", "first_id").alias("component_id"), "n")
    return join_counted(found, stored(placed, "placed"), ["bits"]).select("doc_id", "bits", "component_id")


def as_text(bits: Column) -> Column:
    """A fingerprint as 16 lowercase hex digits."""
    return F.lpad(F.lower(F.hex(bits)), 16, "0")
