"""Which folders of a stored table count.

The rows of a table lie in folders that are written once and never changed. A commit is a small numbered file
that lists, as entries, the folders that count; the newest one is the table. It is written under another name and
renamed, so it is there as a whole or not at all, and a name that is taken is not replaced: of two writers that
started from the same commit the second one fails, and what it wrote never counts. HDFS renames like that; on stores
that don't, one writer at a time has to be seen to.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors.exceptions.captured import CapturedException
from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from duelframe.errors import ConcurrentLoadError

#: Commits whose folders stay for readers that have begun, and commit files that stay.
KEPT, KEPT_FILES = 2, 10


@dataclass(frozen=True)
class Commit:
    """Number and entries of a commit; number 0 has none and stands for a table that isn't there yet."""

    number: int
    entries: tuple[dict, ...]

    def folders(self) -> set[str]:
        return {entry[k] for entry in self.entries for k in entry if k in ("folder", "counts")}


def _path(spark: SparkSession, name: str):
    return spark._jvm.org.apache.hadoop.fs.Path(name)


def _system(spark: SparkSession, name: str):
    return _path(spark, name).getFileSystem(spark._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this package has written, if it is there."""
    _system(spark, path).delete(_path(spark, path), True)


def _file(table: str, number: int) -> str:
    return f"{table}/commit-{number:010d}"


def _numbers(spark: SparkSession, table: str) -> list[int]:
    found = _system(spark, table).globStatus(_path(spark, f"{table}/commit-*"))
    return sorted(int(f.getPath().getName().removeprefix("commit-")) for f in (found or []))


def _read(spark: SparkSession, table: str, number: int) -> Commit:
    name = _file(table, number)
    stream = _system(spark, name).open(_path(spark, name))
    try:
        return Commit(number, tuple(json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))))
    finally:
        stream.close()


def newest(spark: SparkSession, table: str) -> Commit:
    """The commit that is the table now."""
    numbers = _numbers(spark, table)
    return _read(spark, table, numbers[-1]) if numbers else Commit(0, ())


def new_folder(kind: str) -> str:
    """A name within a table that no other writer has."""
    return f"{kind}-{uuid.uuid4().hex}"


def commit(spark: SparkSession, table: str, before: Commit, entries: Sequence[dict]) -> Commit:
    """Make `entries` the table, if it is still as `before` says; raises ConcurrentLoadError if not.

    Folders that none of the last KEPT commits lists are deleted.
    """
    numbers = _numbers(spark, table)
    if (numbers or [0])[-1] != before.number:
        raise ConcurrentLoadError(f"another load has changed {table}")
    made = Commit(before.number + 1, tuple(entries))
    system = _system(spark, table)
    written = f"{table}/.{uuid.uuid4().hex}"
    out = system.create(_path(spark, written), False)
    out.write(bytearray(json.dumps(made.entries).encode()))
    out.close()
    files = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(_path(spark, table).toUri() if "://" in table else system.getUri(), spark._jsc.hadoopConfiguration())
    plainly = spark._sc._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        files.rename(_path(spark, written), _path(spark, _file(table, made.number)), plainly)
    except (Py4JJavaError, CapturedException) as e:
        remove(spark, written)
        raise ConcurrentLoadError(f"another load has changed {table}") from e
    kept = [made, before, *[_read(spark, table, n) for n in numbers[-KEPT:-1]]]
    for old in kept[KEPT:]:
        for folder in old.folders() - set().union(*[c.folders() for c in kept[:KEPT]]):
            remove(spark, f"{table}/{folder}")
    for number in numbers[:-KEPT_FILES]:
        remove(spark, _file(table, number))
    return made
