"""Packing of tokenised documents into sequences of fixed length.

A document of n tokens gives n // window whole windows and a remainder. The remainders' lengths,
counted in steps of `grain` tokens, form a histogram of fixed size. All combinations of up to three
lengths that fill a window are enumerated, and non-negative least squares finds how often to use each
one. The counts are rounded down and, where lengths run short, cut to what there is. Remainders are
then dealt to the combinations by their rank within their length; the few tokens by which a sequence
would overflow, because lengths are rounded down to a step, and the remainders that no combination
took are packed greedily, end to end, into sequences of their own. All of these are full; the few tokens
left in the end go to sequences whose lengths are powers of two, which need no padding either.

Documents may come in an order that sequences have to follow, such as that of a mix. The order is then cut
into stretches with a histogram and combinations of their own, so that what is combined stands close together,
remainders are dealt by their place in it, and sequences are numbered by the first of their pieces.
"""

from __future__ import annotations

import functools
import re
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from duelframe.llm.common import Cache, spread, stored, texts_of, vocabulary_file

WINDOW = 2048
#: Tokens of a step in the histogram of lengths.
GRAIN = 32
VOCABULARY = "word_bpe_49k.json"
END_ID = 1
#: Remainders whose ranks one task works out.
ROWS_PER_BUCKET = 50_000
#: Documents of a stretch of the order at least, so that its lengths combine, and stretches at most, for the driver's plans.
ROWS_PER_STRETCH = 2_000
MOST_STRETCHES = 32


#: Words of letters that keep their form under NFC, then marks that can't belong to a special token.
_LETTERS, _MARKS = "a-zß-öø-ÿ", r"!-&(-/:;=?@\[-`{}~"
_PLAIN = re.compile(rf"([{_LETTERS}]+)([{_MARKS}]*)\Z")


@functools.lru_cache(maxsize=2)
def word_encoder(path: str) -> tuple[Cache, str]:
    """Cache from a word between blanks to the bytes of its ids, and the ids' type: 16 or 32 bits, little-endian.

    The tokenizer drops white space and never joins what it parts, so a text's ids are those of its words.
    It parts letters and the marks after them too; those go to the tokenizer's model one by one, since
    most words differ by case or marks alone. All other words go through the whole tokenizer.
    """
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    kind = "<u2" if tokenizer.get_vocab_size() < 1 << 16 else "<u4"
    alphabet = [chr(c) for c in range(33, 256) if re.fullmatch(f"[{_LETTERS}{_MARKS}]", chr(c))]
    mapped = str.maketrans({c: "".join(p for p, _ in tokenizer.pre_tokenizer.pre_tokenize_str(c)) for c in alphabet})
    packed = struct.Struct("<H" if kind == "<u2" else "<I").pack

    def part(piece: str) -> bytes:
        return b"".join([packed(t.id) for t in tokenizer.model.tokenize(piece.translate(mapped))])

    parts = Cache(part)

    def encode(word: str) -> bytes:
        plain = _PLAIN.match(word.lower())
        if plain is None:
            return np.array(tokenizer.encode(word, add_special_tokens=False).ids, dtype=kind).tobytes()
        return parts[plain[1]] + parts[plain[2]] if plain[2] else parts[plain[1]]

    return Cache(encode), kind


def tokenise(documents: DataFrame, vocabulary: str | None = None, end_id: int = END_ID, order: str | None = None) -> DataFrame:
    """One row per document: row, doc_id, hash, key, ids (16- or 32-bit numbers as binary, `end_id` last), n_tokens.

    A null text is empty and has the end id alone. `hash` is that of id and text. Rows are ordered by `key`,
    which is the column `order` or else the hash; `row` tells repeated rows apart. It holds once the result is
    stored, not before.
    """
    path = vocabulary or vocabulary_file(VOCABULARY)

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, kind = word_encoder(path)
        last = np.array([end_id], dtype=kind).tobytes()
        for frame in frames:
            ids = [b"".join(map(words.__getitem__, text.replace("\n", " ").split(" "))) + last if text else last for text in texts_of(frame["text"])]
            yield frame.drop(columns="text").assign(ids=ids, n_tokens=[len(x) // np.dtype(kind).itemsize for x in ids])

    key = F.col(order).cast("long") if order else spread("doc_id", "text")
    rows = documents.select(F.monotonically_increasing_id().alias("row"), "doc_id", spread("doc_id", "text").alias("hash"), key.alias("key"), "text")
    kind = documents.schema["doc_id"].dataType.simpleString()
    return rows.mapInPandas(encode, f"row long, doc_id {kind}, hash long, key long, ids binary, n_tokens long")


def combinations(steps: int) -> list[tuple[int, ...]]:
    """All ways to fill `steps` steps with one to three lengths, longest first."""
    found: list[tuple[int, ...]] = [(a, steps - a) for a in range((steps + 1) // 2, steps)]
    for a in range((steps + 2) // 3, steps - 1):
        for b in range((steps - a + 1) // 2, min(a, steps - a - 1) + 1):
            found.append((a, b, steps - a - b))
    return found


def nnls(a: np.ndarray, h: np.ndarray, rounds: int = 3000) -> np.ndarray:
    """x >= 0 that makes |a x - h| least: projected gradient steps with momentum, restarted when they rise.

    The matrix has a row per length and a column per combination, a fixed size whatever the input.
    """
    gram, right = a.T @ a, a.T @ h
    step = 1.0 / np.linalg.norm(gram, 2)
    x = y = np.zeros(a.shape[1])
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(0, y - step * (gram @ y - right))
        if (y - new) @ (new - x) > 0:
            t, y = 1.0, x
            continue
        further = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = new + (t - 1) / further * (new - x)
        if np.abs(new - x).max(initial=0) <= 1e-9 * (1 + np.abs(new).max(initial=0)):
            x = new
            break
        x, t = new, further
    return x


def plan(histogram: dict[int, int], steps: int) -> list[tuple[tuple[int, ...], int]]:
    """How often to use each combination, never more than the histogram's lengths allow."""
    ways = combinations(steps)
    a = np.zeros((steps, len(ways)))
    for j, way in enumerate(ways):
        for length in way:
            a[length, j] += 1
    h = np.array([histogram.get(i, 0) for i in range(steps)], dtype=float)
    h[0] = 0
    top = max(1.0, h.max(initial=0))
    want = np.floor(nnls(a, h / top) * top + 1e-6).astype(np.int64)
    left, chosen = h.astype(np.int64), []
    for counts in (want, np.full(len(ways), np.iinfo(np.int64).max)):  # then whatever still fits whole
        for j in sorted(range(len(ways)), key=lambda j: (-int(counts[j]), j)):
            needs = {i: int(a[i, j]) for i in set(ways[j])}
            n = min([int(counts[j]), *(int(left[i]) // k for i, k in needs.items())])
            if n > 0:
                chosen.append((ways[j], n))
                for i, k in needs.items():
                    left[i] -= n * k
    return chosen


def _slots(chosen: list[tuple[tuple[int, ...], int]], stretch: int, sequence: int) -> list[tuple[int, int, int, int, int, int]]:
    """(stretch, length, first rank, end rank, first sequence, slot): ranks of a length in the order of use."""
    used: dict[int, int] = {}
    rows = []
    for way, n in chosen:
        for slot, length in enumerate(way):
            first = used.get(length, 0)
            used[length] = first + n
            rows.append((stretch, length, first, first + n, sequence, slot))
        sequence += n
    return rows


def _part(low: int, high: int, parts: int) -> F.Column:
    """The part of the range from `low` to `high` that a key lies in, of `parts` equal ones."""
    share = (F.col("key").cast("double") - float(low)) / (float(high) - float(low) + 1.0)
    return F.greatest(F.lit(0), F.least(F.lit(parts - 1), F.floor(share * parts))).cast("int")


def _ranked(rows: DataFrame, groups: list[str], weight: F.Column, bucket: F.Column) -> DataFrame:
    """`before`: the sum of `weight` over the rows of the same group that come before, by bucket and key.

    Sums are taken per group and bucket before anything is ordered, so a group with a third of all rows
    is spread over all buckets.
    """
    rows = rows.withColumn("_w", weight).withColumn("_b", bucket)
    sums = rows.groupBy(*groups, "_b").agg(F.sum("_w").alias("_s"))
    earlier = Window.partitionBy(*groups).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*groups, "_b", F.coalesce(F.sum("_s").over(earlier), F.lit(0)).alias("_o"))
    own = Window.partitionBy(*groups, "_b").orderBy("key", "row", "start").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_i", F.coalesce(F.sum("_w").over(own), F.lit(0)))
    return rows.join(sums, [*groups, "_b"]).withColumn("before", F.col("_o") + F.col("_i")).drop("_w", "_b", "_s", "_o", "_i")


def pack(documents: DataFrame, window: int = WINDOW, grain: int = GRAIN, vocabulary: str | None = None, end_id: int = END_ID, order: str | None = None) -> DataFrame:
    """Pieces of documents in sequences of `window` tokens, and of powers of two for what is left in the end.

    Returns doc_id, start, length, ids (the piece's ids as 32-bit little-endian numbers), doc_tokens,
    sequence_id, offset and kind (`whole` window, `combined`, `residual`). Null texts are empty; an empty
    table gives no piece; repeated rows are documents of their own; null doc_ids are kept. Other columns
    are not read. No text is cut short; each id is in exactly one piece.

    `order` names a column of whole numbers without nulls that sequences are to follow, smallest first; numbers in even
    steps keep tasks even. Sequences are then numbered by the first of their pieces in that order, and `epoch` is added:
    how many rows of the same id and text come before the document. Without it, the order is one without pattern.
    """
    if window % grain or window // grain < 3:
        raise ValueError("the window must hold three steps at least, all of one size")
    spark, steps = documents.sparkSession, window // grain
    tokens = stored(tokenise(documents, vocabulary, end_id, order), "tokens")
    length = F.col("n_tokens") % window
    rows = tokens.select("row", "key", F.floor(F.col("n_tokens") / window).alias("wholes"),
                         (F.col("n_tokens") - length).alias("start"), length.alias("length"), F.floor(length / grain).cast("int").alias("bin"))
    stretches, low, high = 1, 0, (1 << 63) - 1
    if order:
        n, low, high = rows.agg(F.count(F.lit(1)), F.coalesce(F.min("key"), F.lit(0)), F.coalesce(F.max("key"), F.lit(0))).first()  # one row
        stretches = max(1, min(MOST_STRETCHES, n // ROWS_PER_STRETCH))
    rows = rows.withColumn("stretch", _part(low, high, stretches) if stretches > 1 else F.lit(0))
    counted = rows.groupBy("stretch", "bin").agg(F.count(F.lit(1)).alias("n"), F.sum("wholes").alias("wholes"), F.sum(F.col("start") + F.col("length")).alias("tokens")).collect()  # one row per stretch and length
    n_whole = sum(r["wholes"] for r in counted)
    buckets = max(16, -(-sum(r["n"] for r in counted) // ROWS_PER_BUCKET))
    bucket = _part(low, high, buckets) if order else (F.col("key") % F.lit(buckets)).cast("int")
    uses, n_combined = [], 0
    for stretch in sorted({r["stretch"] for r in counted}):
        chosen = plan({r["bin"]: r["n"] for r in counted if r["stretch"] == stretch}, steps)
        uses += _slots(chosen, stretch, n_combined)
        n_combined += sum(n for _, n in chosen)

    # Whole windows: numbered by a running count of the windows before the document.
    wholes = rows.where("wholes > 0").withColumn("one", F.lit(0))
    whole = None if order else _ranked(wholes, ["one"], F.col("wholes"), bucket).select("row", F.col("before").alias("first_whole"))

    # Combined: the rank within a length names sequence and slot. The table of slots has a fixed bound.
    slots = F.broadcast(spark.createDataFrame(uses or [(-1, -1, 0, 0, 0, 0)], "stretch int, bin int, first long, past long, sequence long, slot int"))
    ranked = _ranked(rows.where("length > 0"), ["stretch", "bin"], F.lit(1), bucket)
    dealt = ranked.join(slots, (ranked["stretch"] == slots["stretch"]) & (ranked["bin"] == slots["bin"]) & (F.col("before") >= F.col("first")) & (F.col("before") < F.col("past")), "left")
    sequence = (F.col("sequence") + F.col("before") - F.col("first") + n_whole).alias("sequence_id")
    dealt = stored(dealt.select("row", "key", "start", "length", sequence, "slot"), "dealt")
    within = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    combined = dealt.where("slot IS NOT NULL").withColumn("offset", F.coalesce(F.sum("length").over(within), F.lit(0)))
    combined = combined.withColumn("fits", F.greatest(F.lit(0), F.least("length", F.lit(window) - F.col("offset"))))
    taken = combined.where("fits > 0").select("row", "key", "start", F.col("fits").alias("length"), "sequence_id", "offset", F.lit("combined").alias("kind"))

    # Residuals: cut-off ends and unused remainders, laid end to end from the next sequence on.
    ends = combined.where("fits < length").select("row", "key", (F.col("start") + F.col("fits")).alias("start"), (F.col("length") - F.col("fits")).alias("length"))
    rest = dealt.where("slot IS NULL").select("row", "key", "start", "length").unionByName(ends).withColumn("one", F.lit(0))
    rest = _ranked(rest, ["one"], F.col("length"), bucket)
    rest = stored(rest.select("row", "key", "start", "length", "before", (F.col("before") + F.col("length")).alias("past")), "rest")
    n_rest = sum(r["tokens"] for r in counted) - (n_whole + n_combined) * window
    end, last = n_rest // window * window, n_whole + n_combined + n_rest // window
    touched = F.sequence(F.floor(F.col("before") / window), F.floor((F.least("past", F.lit(end)) - 1) / window))
    spans = rest.where(F.col("before") < end).withColumn("i", F.explode(touched))
    spans = spans.withColumns({"from": F.col("i") * window, "upto": (F.col("i") + 1) * window, "id": F.col("i") + n_whole + n_combined}).drop("i")
    powers = [1 << b for b in reversed(range(window.bit_length())) if n_rest % window >> b & 1]
    ends = [end + sum(powers[: i + 1]) for i in range(len(powers))]
    tail = [F.struct(F.lit(e - p).cast("long").alias("from"), F.lit(e).cast("long").alias("upto"), F.lit(last + i).cast("long").alias("id")) for i, (p, e) in enumerate(zip(powers, ends, strict=True))]
    if tail:
        spans = spans.unionByName(rest.where(F.col("past") > end).select("*", F.inline(F.array(*tail))).where("before < upto AND past > `from`"))
    begin, until = F.greatest("before", "from"), F.least("past", "upto")
    residual = spans.select("row", "key", (F.col("start") + begin - F.col("before")).alias("start"), (until - begin).alias("length"),
                            F.col("id").cast("long").alias("sequence_id"), (begin - F.col("from")).alias("offset"), F.lit("residual").alias("kind"))

    # A remainder has a few pieces at most; whole windows are cut from the number of their first sequence.
    pieces = taken.unionByName(residual)
    if order:
        pieces, whole = _renumbered(stored(pieces, "cuts"), wholes, bucket)
    pieces = pieces.groupBy("row").agg(F.collect_list(F.struct("start", "length", "sequence_id", "offset", "kind")).alias("pieces"))
    placed = pieces.join(whole, "row", "full")
    if order:  # rows of one id and text are the epochs of a document
        again = Window.partitionBy("hash").orderBy("key", "row")
        placed = placed.join(tokens.select("row", (F.row_number().over(again) - 1).cast("long").alias("epoch")), "row")
    placed = stored(placed, "pieces")
    joined = tokens.select("row", "doc_id", "ids", "n_tokens").join(placed, "row")
    kind = documents.schema["doc_id"].dataType.simpleString()

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out: list[tuple] = []
            epochs = frame["epoch"] if order else [None] * len(frame)
            for doc, ids, n, some, first, epoch in zip(frame["doc_id"], frame["ids"], frame["n_tokens"], frame["pieces"], frame["first_whole"], epochs, strict=True):
                each = np.frombuffer(ids, dtype="<u2" if len(ids) == 2 * n else "<u4").astype("<u4")
                spans = [(i * window, window, int(first) + i, 0, "whole") for i in range(n // window)]
                if some is not None:
                    spans += [(p["start"], p["length"], p["sequence_id"], p["offset"], p["kind"]) for p in some]
                for start, long, sequence, offset, what in spans:
                    out.append((doc, start, long, each[start : start + long].tobytes(), n, sequence, offset, what, epoch)[: len(names)])
                if len(out) >= 5000:
                    yield pd.DataFrame(out, columns=names)
                    out = []
            yield pd.DataFrame(out, columns=names)

    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "kind", *(["epoch"] if order else [])]
    schema = f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, kind string"
    return joined.mapInPandas(cut, schema + (", epoch long" if order else ""))


def _renumbered(pieces: DataFrame, wholes: DataFrame, bucket: F.Column) -> tuple[DataFrame, DataFrame]:
    """The pieces, and row and first_whole of the whole windows, with sequences numbered by the smallest key in them.

    The windows of one document follow each other.
    """
    found = pieces.groupBy("sequence_id").agg(F.min("key").alias("key"))
    units = found.select("key", F.lit(None).cast("long").alias("row"), F.col("sequence_id").alias("start"), F.lit(1).cast("long").alias("weight"))
    units = units.unionByName(wholes.select("key", "row", F.lit(0).cast("long").alias("start"), F.col("wholes").alias("weight"))).withColumn("one", F.lit(0))
    numbered = stored(_ranked(units, ["one"], F.col("weight"), bucket).select("row", "start", "before"), "numbers")
    named = numbered.where("row IS NULL").select(F.col("start").alias("sequence_id"), F.col("before").alias("number"))
    pieces = pieces.join(named, "sequence_id").drop("sequence_id").withColumnRenamed("number", "sequence_id")
    return pieces, numbered.where("row IS NOT NULL").select("row", F.col("before").alias("first_whole"))
