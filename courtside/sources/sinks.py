"""Writers.

An upsert table is a folder of attempts, ``version=<n>/attempt=<id>``, and a manifest that names the live ones. A batch writes its
attempt first and then switches the manifest: the next manifest is a new file, put in place by one rename that fails if another
writer was faster, in which case the change is made again on top of that writer's. Readers take the newest manifest and read what
it names; an attempt is never changed or moved, so a reader goes on with its manifest whatever is written, compacted or replaced
meanwhile, until ``vacuum`` removes what only older manifests name. (The rename is atomic on HDFS and local disks; an object store
needs a committer of its own.)
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.operators.skew import last_row
from courtside.session import hadoop_path, shuffles_removed

#: column of a row's version; the folder's name has it as well, but a compacted folder holds rows of many
VERSION = "_version"
#: the version of compacted folders
COMPACTED = -1
MANIFESTS = "_manifest"
COMMIT_ATTEMPTS = 20


def write_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet", mode: str = "overwrite",
    keep_other_partitions: bool = False,
) -> None:
    """Writes a table, by default as parquet.

    Partition columns are spread evenly first, so that a directory does not get one small file from every task and a
    large one is not written by a single task. ``keep_other_partitions`` replaces only the directories that get rows.
    """
    if partition_by:
        # rebalance keeps rows of a directory together, and adaptive execution splits the directories that are large
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        # keep blanks around text
        writer = writer.options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    elif fmt == "parquet":
        writer = writer.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if keep_other_partitions:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    with shuffles_removed(df.sparkSession):
        writer.save(path)


def write_entities(df: DataFrame, path: str, levels: Sequence[str]) -> None:
    """Entities below one directory per level; many rows per file instead of one file per row."""
    write_table(df, path, partition_by=levels)


def append_predictions(df: DataFrame, path: str) -> None:
    write_table(df, path, mode="append")


class Live(NamedTuple):
    """A manifest: its number (0 before the first one) and the folders that are live, as version and folder name."""

    number: int
    folders: list[tuple[int, str]]


def _manifest_numbers(spark: SparkSession, path: str) -> list[int]:
    folder, system = hadoop_path(spark, f"{path}/{MANIFESTS}")
    if not system.exists(folder):
        return []
    names = [f.getPath().getName() for f in system.listStatus(folder)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))


def _manifest(spark: SparkSession, path: str, number: int) -> Live:
    file, system = hadoop_path(spark, f"{path}/{MANIFESTS}/{number:012d}.json")
    stream = system.open(file)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return Live(number, [(f["version"], f["folder"]) for f in json.loads(text)["folders"]])


def live(spark: SparkSession, path: str) -> Live:
    """The newest manifest."""
    numbers = _manifest_numbers(spark, path)
    return _manifest(spark, path, numbers[-1]) if numbers else Live(0, [])


def _switch(spark: SparkSession, path: str, now: Live, folders: list[tuple[int, str]]) -> bool:
    """Makes ``folders`` the next manifest after ``now``; false if another writer has made that one."""
    waiting, system = hadoop_path(spark, f"{path}/{MANIFESTS}/.{uuid.uuid4().hex}")
    stream = system.create(waiting, False)
    stream.writeBytes(json.dumps({"folders": [{"version": v, "folder": f} for v, f in folders]}))
    stream.close()
    file, _ = hadoop_path(spark, f"{path}/{MANIFESTS}/{now.number + 1:012d}.json")
    fs = spark._jvm.org.apache.hadoop.fs
    rename = getattr(fs, "Options$Rename")
    never_replace = spark.sparkContext._gateway.new_array(rename, 1)
    never_replace[0] = rename.NONE
    try:
        fs.FileContext.getFileContext(waiting.toUri(), spark._jsc.hadoopConfiguration()).rename(waiting, file, never_replace)
    except Py4JJavaError as error:
        system.delete(waiting, False)
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def _commit(spark: SparkSession, path: str, change: Callable[[list[tuple[int, str]]], list[tuple[int, str]] | None]) -> bool:
    """Switches to what ``change`` makes of the live folders, again after each switch by another writer; false if it gives it up."""
    for _ in range(COMMIT_ATTEMPTS):
        now = live(spark, path)
        folders = change(now.folders)
        if folders is None:
            return False
        if _switch(spark, path, now, folders):
            return True
    raise RuntimeError(f"other writers switched {path} {COMMIT_ATTEMPTS} times in between")


def _attempt(version: int) -> str:
    return f"version={version}/attempt={uuid.uuid4().hex}"


def write_version(df: DataFrame, path: str, version: int, key: Sequence[str] = (), order: Sequence[Column] = ()) -> None:
    """Writes one batch of an upsert table. A repeated version replaces itself, so a retry leaves no duplicates.

    With a ``key`` the batch is reduced to the row of each key with the greatest ``order`` first. Without an order a key that
    repeats inside the batch is refused: which row would win is not defined. A version that has been compacted is added again
    when it is repeated: its rows have the version they had, so they change nothing.
    """
    if key and order:
        df = last_row(df, list(key), F.struct(*order), [c for c in df.columns if c not in key])
    elif key and df.groupBy(*key).count().filter("count > 1").limit(1).count():
        raise ValueError(f"keys {list(key)} repeat inside the batch and no order says which row is the last")
    folder = _attempt(version)
    df.withColumn(VERSION, F.lit(version).cast("long")).write.parquet(f"{path}/{folder}")
    _commit(df.sparkSession, path, lambda folders: [f for f in folders if f[0] != version] + [(version, folder)])


def read_live(spark: SparkSession, path: str, at: Live | None = None) -> DataFrame:
    """All rows of the live folders with their version, of the newest manifest or of one that the reader holds."""
    at = at or live(spark, path)
    if not at.folders:
        raise ValueError(f"{path} has no manifest")
    return spark.read.parquet(*[f"{path}/{folder}" for _, folder in at.folders])


def current_rows(log: DataFrame, key: Sequence[str], order: Sequence[Column] = (), keep_version: bool = False) -> DataFrame:
    """Current state of an upsert table: per key the row with the greatest ``order``, or of the newest version.

    A batch costs its own size, not the size of the table; the newest row is found with one partial aggregation.
    """
    cols = [c for c in log.columns if c not in key and (keep_version or c != VERSION)]
    return last_row(log, list(key), F.struct(*order, F.col(VERSION)), cols)


def read_current(
    spark: SparkSession, path: str, key: Sequence[str], order: Sequence[Column] = (), at: Live | None = None,
) -> DataFrame:
    return current_rows(read_live(spark, path, at), key, order)


def compact_versions(spark: SparkSession, path: str, key: Sequence[str], order: Sequence[Column] = ()) -> bool:
    """Replaces the live folders by one with the current rows, each with its version. Batches that land meanwhile stay live beside
    it. False, and nothing is switched, if one of the folders has been replaced meanwhile."""
    before = live(spark, path)
    folder = _attempt(COMPACTED)
    current_rows(read_live(spark, path, before), key, order, keep_version=True).write.parquet(f"{path}/{folder}")

    def change(folders: list[tuple[int, str]]) -> list[tuple[int, str]] | None:
        if not set(before.folders) <= set(folders):
            return None
        return [(COMPACTED, folder), *[f for f in folders if f not in before.folders]]

    return _commit(spark, path, change)


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Removes what only manifests before the last ``keep`` name, and those manifests; returns the removed folders. Attempts that no
    manifest names yet belong to batches under way and stay."""
    numbers = _manifest_numbers(spark, path)
    old, kept = numbers[:-keep], numbers[-keep:]
    needed = {f for n in kept for _, f in _manifest(spark, path, n).folders}
    gone = sorted({f for n in old for _, f in _manifest(spark, path, n).folders} - needed)
    for name in [*gone, *(f"{MANIFESTS}/{n:012d}.json" for n in old)]:
        target, system = hadoop_path(spark, f"{path}/{name}")
        system.delete(target, True)
    return gone


def compact(spark: SparkSession, path: str, target: str, key: Sequence[str], order: Sequence[Column] = ()) -> None:
    """Current state as a plain table of its own."""
    write_table(read_current(spark, path, key, order), target)
