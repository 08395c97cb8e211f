"""Document fingerprints by locally consistent parsing.

A text is a sequence of names, at first its code points. On every level equal neighbours are joined to
runs; deterministic coin tossing gives each name a label that depends on its neighbour to the left alone,
and three tosses leave fewer than eight labels. Phrases begin where labels have a local maximum, and a
phrase's name is a hash of its names. Where phrases begin depends on a few names nearby, so equal
substrings have equal phrases inside, wherever they stand. The names of the upper levels are the text's
signatures, and its fingerprint keeps the smallest of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelframe.llm.common import texts_of

#: Signatures of a fingerprint, as 32-bit numbers.
SIZE = 64
#: Phrases from this level on are signatures (about fifteen characters), and so are those of any level with few of them.
LEVEL = 3
FEW = 12
#: Documents that one range holds; each range is parsed in one task.
ROWS_PER_RANGE = 1000
#: Ranges at most, whose bounds each task knows; ranges hold more rows beyond it and are read as a stream.
MOST_RANGES = 20_000
#: Code points that are parsed at once; a longer text is parsed by itself.
BATCH = 400_000
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _B
    return x ^ (x >> np.uint64(29))


def _toss(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Twice the lowest bit in which a name differs from the one to its left, plus that bit."""
    one = names.dtype.type(1)
    left = np.empty_like(names)
    left[1:] = names[:-1]
    left[first] = names[first] ^ one
    differ = names ^ left
    low = differ & (~differ + one)
    return (2 * np.bitwise_count(low - one) + ((names & low) != 0)).astype(np.uint8)


def phrases(names: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One level: names of the phrases of several texts, and where each text begins. `first`: where they began."""
    n = len(names)
    head = np.zeros(n, bool)
    head[first] = True
    # Runs of a name become one name.
    fresh = head.copy()
    fresh[1:] |= names[1:] != names[:-1]
    starts = np.flatnonzero(fresh)
    if len(starts) < n:
        length = np.diff(starts, append=n).astype(np.uint64)
        names = np.where(length > 1, _mix(names[starts] + length * _A), names[starts])
        head = head[starts]
        first, n = np.flatnonzero(head), len(names)
    label = _toss(_toss(_toss(names, first), first), first).astype(np.int16)
    before, after = np.empty_like(label), np.empty_like(label)
    before[1:], after[:-1] = label[:-1], label[1:]
    before[first] = 99
    last = np.append(first[1:], n) - 1
    after[last] = 99
    begin = np.flatnonzero(head | ((label > before) & (label >= after)))
    place = np.arange(n) - np.repeat(begin, np.diff(begin, append=n))
    named = _mix(np.add.reduceat(_mix(names + (place + 1).astype(np.uint64) * _A), begin))
    return named, np.flatnonzero(head[begin])


def signatures(texts: list[str]) -> list[np.ndarray]:
    """The set of each text's signatures as sorted 32-bit numbers; empty for an empty text."""
    found: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(texts)
    alive = np.array([i for i, t in enumerate(texts) if t], dtype=np.int64)
    if not len(alive):
        return found
    raw = [np.frombuffer(texts[i].encode("utf-32-le", "surrogatepass"), "<u4") for i in alive]
    first = np.concatenate([[0], np.cumsum([len(x) for x in raw])[:-1]]).astype(np.int64)
    names = _mix(np.concatenate(raw).astype(np.uint64) * _A + _A)
    owners, kept, level = [], [], 0
    while len(alive):
        names, first = phrases(names, first)
        level += 1
        lengths = np.diff(first, append=len(names))
        keep = np.repeat((lengths <= FEW) | (level >= LEVEL), lengths)
        owner = np.repeat(alive, lengths)
        owners.append(owner[keep])
        kept.append(names[keep])
        go = lengths > 1
        if not go.all():
            names, alive, lengths = names[np.repeat(go, lengths)], alive[go], lengths[go]
            first = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64) if len(lengths) else first[:0]
    both = np.unique((np.concatenate(owners).astype(np.uint64) << np.uint64(32)) | (np.concatenate(kept) >> np.uint64(32)))
    owner = (both >> np.uint64(32)).astype(np.int64)
    cut = np.searchsorted(owner, np.arange(len(texts) + 1))
    values = (both & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    return [values[cut[i] : cut[i + 1]] for i in range(len(texts))]


def fingerprints(texts: list[str]) -> list[str]:
    """Hex text of the SIZE smallest signatures of each text; empty for an empty text."""
    out, batch, size = [], [], 0
    for text in texts:
        if batch and size + len(text) > BATCH:
            out += signatures(batch)
            batch, size = [], 0
        batch.append(text)
        size += len(text)
    return [x[:SIZE].astype(">u4").tobytes().hex() for x in out + signatures(batch)]


def likeness(a: str, b: str) -> float:
    """Estimated share of common signatures, 0 to 1: of the smallest ones of both, those that both have."""
    if a == b:
        return 1.0
    x, y = np.frombuffer(bytes.fromhex(a), ">u4"), np.frombuffer(bytes.fromhex(b), ">u4")
    if not len(x) or not len(y):
        return 0.0
    smallest = np.union1d(x, y)
    if len(x) >= SIZE or len(y) >= SIZE:
        smallest = smallest[:SIZE]
    return float(np.isin(smallest, np.intersect1d(x, y), assume_unique=True).mean())


def edited(text: str, following: str) -> str:
    """The text with its second half replaced by as many first characters of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprint(documents: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and their likeness, in descending order of ids.

    The last document is followed by the first one. Null texts are empty and null ids come last. Rows of
    the same id are ordered by their texts; a single document follows itself. An empty table gives no row.
    Ids are whole numbers of up to 64 bits; others raise a TypeError before anything is read.
    Ranges of ids are cut at ids that occur; the rows of such an id also go to the range before, as
    the followers of its last row, so that texts are shuffled once and no task depends on another.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()
    if kind not in ("tinyint", "smallint", "int", "bigint"):
        raise TypeError(f"doc_id is {kind}, not a whole number")
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("at"))
    n = rows.count()
    ranges = min(MOST_RANGES, max(1, -(-n // rows_per_range)))
    cuts = rows.agg(F.max("at").alias("top"), F.percentile_approx("at", [i / ranges for i in range(1, ranges)] or [0.5], 10 * ranges + 1000).alias("cuts")).first()
    bounds = sorted({cuts["top"], *((cuts["cuts"] or []) if ranges > 1 else [])} - {None}, reverse=True) or [0]
    sent = rows.sparkSession.sparkContext.broadcast(np.array(bounds[::-1], dtype=np.int64))  # one id per range
    count = len(bounds)

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Range of each row, and again, as a follower, the rows that begin the next range."""
        rising = sent.value
        for frame in frames:
            at = frame["at"].to_numpy(np.int64)
            own = count - 1 - np.searchsorted(rising, at)  # range i holds the ids from bounds[i] down to above bounds[i + 1]
            follows = frame[np.isin(at, rising)]
            yield frame.assign(part=own, extra=0)
            if len(follows):
                yield follows.assign(part=(count - 2 - np.searchsorted(rising, follows["at"].to_numpy(np.int64))) % count, extra=1)

    placed = rows.mapInPandas(place, f"doc_id {kind}, text string, at long, part long, extra int")
    # A range's follower comes last. In the range that holds a row twice, the first range of one, it follows itself.
    tasks = max(1, min(count, max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")), count // 4)))
    ordered = placed.repartition(tasks, "part").sortWithinPartitions("part", "extra", F.col("at").desc(), "text")

    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, done = None, None  # the row that waits for its follower; the range whose follower was taken
        for frame in frames:
            texts = frame["text"].tolist()
            prints = fingerprints(texts)
            current = list(zip(frame["part"], frame["extra"], frame["doc_id"], texts, prints, strict=True))
            pairs = []
            for row in current:
                if held is not None and held[0] == row[0]:
                    pairs.append((held, row))
                    held = None
                if not row[1]:
                    held = row
            if not pairs:
                continue
            others = [edited(a[3], b[3]) for a, b in pairs]
            their = fingerprints(others)
            yield pd.DataFrame({
                "doc_id": [a[2] for a, _ in pairs], "n_chars": [len(a[3]) for a, _ in pairs], "edited_sha256": [hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest() for x in others],
                "fingerprint": [a[4] for a, _ in pairs], "edited_fingerprint": their,
                "near_edited": [likeness(a[4], x) for (a, _), x in zip(pairs, their, strict=True)], "near_next": [likeness(a[4], b[4]) for a, b in pairs],
            })

    return ordered.mapInPandas(parse, f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
