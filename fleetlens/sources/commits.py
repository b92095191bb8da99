"""Which folders a store consists of: numbered snapshots, each an immutable small file.

Rows are written to folders of their own first; they become part of the store by one commit,
which is the creation of ``dest/commits/<number>.json``. A snapshot names everything, so a reader
opens one file and then reads folders that nobody writes to any more: what it sees is the store as
of that commit, whatever is ingested, replaced or replayed meanwhile. Two writers that commit at
the same time get different numbers; the later one applies its change to what the other has made.

The number is claimed by a rename that fails if the file exists, through Hadoop's ``FileContext``
(atomic on HDFS; on object stores as safe as their rename).
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

ATTEMPTS = 100
_NAME = re.compile(r"([0-9]{20})\.json")


def hadoop_path(spark: SparkSession, path: str):
    """(Hadoop file system, path): works for any store that Spark can reach."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def folder_exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_path(spark, path)
    return fs.exists(p)


def folders(spark: SparkSession, path: str) -> list[str]:
    fs, p = hadoop_path(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def remove(spark: SparkSession, path: str) -> None:
    fs, p = hadoop_path(spark, path)
    fs.delete(p, True)


@dataclass(frozen=True)
class Snapshot:
    """``batches``: by batch id what ``sources.store`` knows of it, as plain JSON values."""

    number: int = 0
    batches: dict[str, dict] = field(default_factory=dict)


def _numbers(spark: SparkSession, dest: str) -> list[int]:
    fs, p = hadoop_path(spark, f"{dest.rstrip('/')}/commits")
    if not fs.exists(p):
        return []
    names = (_NAME.fullmatch(s.getPath().getName()) for s in fs.listStatus(p))
    return sorted(int(m[1]) for m in names if m)


def _file(dest: str, number: int) -> str:
    return f"{dest.rstrip('/')}/commits/{number:020d}.json"


def read(spark: SparkSession, dest: str, number: int) -> Snapshot:
    fs, p = hadoop_path(spark, _file(dest, number))
    stream = fs.open(p)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return Snapshot(number, json.loads(text)["batches"])


def current(spark: SparkSession, dest: str) -> Snapshot:
    """The last commit; number 0 and no batches if there is none."""
    numbers = _numbers(spark, dest)
    return read(spark, dest, numbers[-1]) if numbers else Snapshot()


def _create(spark: SparkSession, path: str, text: str) -> bool:
    """Make the file ``path`` with its whole content, or leave an existing one alone."""
    fs, p = hadoop_path(spark, path)
    _, temporary = hadoop_path(spark, f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}.tmp")
    out = fs.create(temporary, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), spark._jsc.hadoopConfiguration()
    )
    rename = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    try:
        options = spark.sparkContext._gateway.new_array(rename, 0)
        context.rename(fs.makeQualified(temporary), fs.makeQualified(p), options)
    except Py4JJavaError as e:
        fs.delete(temporary, False)
        if "FileAlreadyExistsException" in str(e.java_exception):
            return False
        raise
    return True


def commit(
    spark: SparkSession, dest: str, change: Callable[[dict[str, dict]], dict[str, dict]]
) -> Snapshot:
    """Add the snapshot ``change(batches)``; ``change`` is called again if another came first."""
    for _ in range(ATTEMPTS):
        before = current(spark, dest)
        after = Snapshot(before.number + 1, change(json.loads(json.dumps(before.batches))))
        text = json.dumps({"batches": after.batches}, sort_keys=True)
        if _create(spark, _file(dest, after.number), text):
            return after
    raise RuntimeError(f"{dest}: {ATTEMPTS} other commits came first")


def forget(spark: SparkSession, dest: str, keep: int) -> list[Snapshot]:
    """Remove all but the last ``keep`` (at least one) snapshots; those that stay."""
    numbers = _numbers(spark, dest)
    stay = numbers[-max(1, keep) :]
    for n in numbers[: len(numbers) - len(stay)]:
        remove(spark, _file(dest, n))
    return [read(spark, dest, n) for n in stay]
