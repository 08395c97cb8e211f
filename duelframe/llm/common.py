"""What the operators share: the shared folder, stored tables, bounded label samples, word caches."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from duelframe.sources.tables import remove

#: Entries that a word cache of one task may hold. Words beyond it are worked out again each time.
CACHE_WORDS = 300_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Rows that go to a Python worker at once, where the session has Spark's default of 10,000. Both sides hold such a batch
#: of texts, the JVM in off-heap buffers that it keeps, and the worker up to 160 MB for 10,000, which also stay with it.
BATCH_ROWS = 500
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, as Spark does with any zip of modules."""
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, str(BATCH_ROWS))
    context = spark.sparkContext
    if getattr(context, "duelframe_sent", False):
        return
    top = Path(__file__).resolve().parents[1]
    packed = os.path.join(tempfile.mkdtemp(prefix="duelframe-"), f"{top.name}.zip")
    with zipfile.ZipFile(packed, "w") as out:
        for file in sorted(top.rglob("*.py")):
            out.write(file, file.relative_to(top.parent))
    context.addPyFile(packed)
    context.duelframe_sent = True


def shared_folder(spark: SparkSession) -> str:
    """The folder of `spark.checkpoint.dir`, which all executors see.

    Where the setting is missing, a local session gets a temporary folder, once; a cluster must name one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith(("local[", "local*")) and spark.sparkContext.master != "local":
            raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
        named = tempfile.mkdtemp(prefix="duelframe-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def stored(frame: DataFrame, name: str) -> DataFrame:
    """`frame` written once to the shared folder and read back, so that later steps don't repeat it.

    Results are lazy and read such tables, so they stay until `discard` or until the folder is emptied.
    """
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}/{name}"
    frame.write.option("compression", "zstd").parquet(path)
    tables_stored(spark).append(path.rsplit("/", 1)[0])
    return spark.read.schema(frame.schema).parquet(path)


def in_stored_order(frame: DataFrame, name: str) -> DataFrame:
    """`frame` with the column `name`: the number of each row, from 0, in the order in which its Parquet was written.

    Spark's writer numbers part files by partition, and sorted partitions keep their order in them; readers
    don't, since they deal out files by size. A frame that was not read from files has its rows' present order,
    with gaps between partitions.
    """
    try:
        at = frame.metadataColumn("_metadata")
        placed = frame.withColumns({"_file": at["file_path"], name: at["row_index"]})
    except AnalysisException:
        return frame.withColumn(name, F.monotonically_increasing_id())
    # One row per file: folder, number of the part and name give the order; a running total gives each file's first row.
    folder, part = F.regexp_extract("_file", r"^(.*)/[^/]*$", 1), F.coalesce(F.regexp_extract("_file", r"part-(\d+)[^/]*$", 1).try_cast("long"), F.lit(-1))
    files = placed.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(folder, part, "_file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    return placed.join(files, "_file").withColumn(name, F.col(name) + F.col("_first")).drop("_file", "_first")


def tables_stored(spark: SparkSession) -> list[str]:
    """The folders of all tables that this application has stored between steps, oldest first."""
    return vars(spark.sparkContext).setdefault("duelframe_stored", [])


def discard(spark: SparkSession, since: int = 0, keep: int = 0) -> None:
    """Delete the tables stored since there were `since` of them, but for the last `keep`, once no result reads them any more."""
    folders = tables_stored(spark)
    for folder in folders[since : len(folders) - keep]:
        remove(spark, folder)
    del folders[since : len(folders) - keep]


def id_crc(column: str = "doc_id") -> F.Column:
    """crc32 of the id as text; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def spread(*columns: str) -> F.Column:
    """A 64-bit hash of the columns without sign bit: the same for the same row wherever it is computed."""
    return F.xxhash64(*columns).bitwiseAND(F.lit((1 << 63) - 1))


def bounded_sample(rows: DataFrame, label: str, most: int, key: str = "doc_id") -> DataFrame:
    """About `most` rows of each label at most, the ones with the smallest hash of `key`.

    The share of rows per label follows from its count, so that the hash filter leaves a little more
    than `most` rows of a label before they are ranked; a label with a third of all rows costs no more.
    Rows of a label that has no more than `most` rows are all kept. Null labels are left out.
    """
    rows = rows.where(F.col(label).isNotNull()).withColumn("_h", spread(key))
    counts = rows.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    found = {r[label]: r["_n"] for r in counts.collect()}  # one row per label
    kept = None
    for value, n in found.items():
        limit = min((1 << 63) - 1, int((1.2 * most + 50) / n * (1 << 63)))
        part = rows.where((F.col(label) == F.lit(value)) & (F.col("_h") <= F.lit(limit)))
        if n > most:
            part = part.orderBy("_h", key).limit(most)
        kept = part if kept is None else kept.unionByName(part)
    return (rows.limit(0) if kept is None else kept).drop("_h")


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, most: int, learn: Callable[[str], F.Column]) -> list[tuple[str, int]]:
    """(text, label) of at most `most` documents of each label among those that `learn("doc_id")` admits.

    The ids are chosen from the narrow label table, then the documents are read once and joined with
    that bounded set. Repeated label rows of an id count once (the larger label); null ids, null
    labels and ids without a document are left out; a null text is an empty one.
    """
    narrow = labels.select("doc_id", F.col(label).cast("int").alias("label"))
    narrow = narrow.where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & learn("doc_id"))
    narrow = narrow.groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = bounded_sample(narrow, "label", most)
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    return [(r["text"], r["label"]) for r in sorted(found.collect(), key=lambda r: r["doc_id"])]


class Cache(dict):
    """Values of words as `make` gives them, remembered for the first `most` words."""

    def __init__(self, make: Callable[[str], object], most: int = CACHE_WORDS):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, word):
        value = self.make(word)
        if len(self) < self.most:
            self[word] = value
        return value


def texts_of(column) -> list[str]:
    """A pandas column of texts as a list, null as an empty text."""
    return ["" if x is None or x != x else x for x in column]


def vocabulary_file(name: str) -> str:
    """Place of a public tokenizer's file; TOKENIZER_DIR overrides the installed package."""
    if folder := os.environ.get("TOKENIZER_DIR"):
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)
