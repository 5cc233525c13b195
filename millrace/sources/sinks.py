"""Loads into Parquet folders.

Replacing loads write beside the target first and swap by rename, so the plan may read its own
target. The renames are written to an intent file beside the target before the first one: a load that
fails puts back what it had moved, and after a driver is lost in between, the next load of the target
(or ``recover``) does the renames that are left. Adding loads leave the commit to Spark and keep the
partition folders that the target has. The driver touches names only. A folder without data files
counts as no target: rows loaded into it set its columns anew.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.dates import RunWindow
from .staging import stage, unstage


_UNDATED = "__HIVE_DEFAULT_PARTITION__"  # fixed value: folder name of a NULL partition value


def _fs(spark: SparkSession, path: str):
    """Hadoop file system of ``path`` and a string -> Path maker."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsc.hadoopConfiguration()), make


def _beside(path: str, what: str) -> str:
    return f"{path.rstrip('/')}.{what}-{uuid.uuid4().hex}"


def _move(fs, src, dst) -> None:
    if not fs.rename(src, dst):
        raise IOError(f"could not move {src} to {dst}")


def _partitions(fs, make, path: str, part_col: str) -> dict[str, object]:
    """Value -> folder of each ``part_col=value`` under ``path``."""
    if not fs.exists(make(path)):
        return {}
    dirs = [s.getPath() for s in fs.listStatus(make(path)) if s.isDirectory()]
    head = f"{part_col}="
    return {d.getName()[len(head):]: d for d in dirs if d.getName().startswith(head)}


def _day(text: str) -> date | None:
    try:
        return date.fromisoformat(text)
    except ValueError:
        return None


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the target holds a data file."""
    fs, make = _fs(spark, path)
    if not fs.exists(make(path)):
        return False
    files = fs.listFiles(make(path), True)
    while files.hasNext():
        if not files.next().getPath().getName().startswith(("_", ".")):
            return True
    return False


def layout(spark: SparkSession, path: str) -> list[str]:
    """Partition columns of a target, outermost first."""
    fs, make = _fs(spark, path)
    folder, out = make(path), []
    while True:
        below = [s.getPath() for s in fs.listStatus(folder) if s.isDirectory() and "=" in s.getPath().getName()]
        if not below:
            return out
        folder = below[0]
        out.append(folder.getName().split("=")[0])


Move = tuple[str, str]


def _undo(fs, make, done: list[Move]) -> None:
    for src, dst in reversed(done):
        _move(fs, make(dst), make(src))


def _note(fs, make, path: str, moves: list[Move], drop: list[str]) -> None:
    """The intent file appears whole or not at all."""
    draft, marker = make(_beside(path, "draft")), make(f"{path}.intent")
    out = fs.create(draft, True)
    out.write(bytearray(json.dumps({"moves": moves, "drop": drop}).encode()))
    out.close()
    _move(fs, draft, marker)


def _swap(spark: SparkSession, path: str, moves: list[Move], staged: str, drop: list[str]) -> None:
    """Do the renames, all or none; then delete ``drop``."""
    fs, make = _fs(spark, path)
    _note(fs, make, path, moves, drop)
    done: list[Move] = []
    try:
        for src, dst in moves:
            fs.mkdirs(make(dst).getParent())
            _move(fs, make(src), make(dst))
            done.append((src, dst))
    except BaseException:
        _undo(fs, make, done)
        fs.delete(make(f"{path}.intent"), False)
        fs.delete(make(staged), True)
        raise
    fs.delete(make(f"{path}.intent"), False)  # first: with the old rows gone, the renames must not be done again
    for folder in drop:
        fs.delete(make(folder), True)


def recover(spark: SparkSession, path: str) -> bool:
    """Finish a replacing load that a lost driver left half done; whether there was one.

    New rows were complete before the intent was written, so the renames that are left are done: those whose source
    still stands and whose place is free.
    """
    path = path.rstrip("/")
    fs, make = _fs(spark, path)
    marker = make(f"{path}.intent")
    if not fs.exists(marker):
        return False
    file = fs.open(marker)
    intent = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(file, "UTF-8"))
    file.close()
    for src, dst in intent["moves"]:
        if fs.exists(make(src)) and not fs.exists(make(dst)):
            fs.mkdirs(make(dst).getParent())
            _move(fs, make(src), make(dst))
    fs.delete(marker, False)
    for folder in intent["drop"]:
        fs.delete(make(folder), True)
    return True


def full_refresh(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Target becomes exactly ``df``."""
    spark, path = df.sparkSession, path.rstrip("/")
    recover(spark, path)
    staged, old = _beside(path, "staged"), _beside(path, "old")
    df.write.partitionBy(*partition_by).parquet(staged)
    fs, make = _fs(spark, path)
    aside = [(path, old)] if fs.exists(make(path)) else []
    _swap(spark, path, [*aside, (staged, path)], staged, [old])


def ordered_refresh(df: DataFrame, path: str, order: Sequence[Column]) -> None:
    """Target becomes exactly ``df``, in order: by file name, and by row inside each file.

    Rows are cut into ranges of the order, one task and file each, so no task sorts the whole. Rows that tie in all of
    ``order`` share a range; give it a full tie-break. ``read_in_order`` reads the order back.
    """
    full_refresh(df.orderBy(*order), path)


def replace_window(df: DataFrame, path: str, part_col: str, window: RunWindow) -> None:
    """Target rows dated in the window give way to ``df``; days the new rows leave empty disappear.

    The target is partitioned by the date column ``part_col``. Undated new rows replace the undated rows of the target,
    which stay if there are none. New rows dated outside the window are added to their day, file by file. The window's
    old days are moved aside and deleted last.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    recover(spark, path)
    staged, aside = _beside(path, "staged"), _beside(path, "old")
    df.write.partitionBy(part_col).parquet(staged)
    fs, make = _fs(spark, path)
    new, current = _partitions(fs, make, staged, part_col), _partitions(fs, make, path, part_col)

    def inside(value: str) -> bool:
        day = _day(value)
        return value == _UNDATED and value in new or day is not None and window.start <= day <= window.end

    at = lambda top, value: f"{top}/{part_col}={value}"
    moves = [(folder.toString(), at(aside, value)) for value, folder in current.items() if inside(value)]
    for value, folder in new.items():
        if inside(value):
            moves.append((folder.toString(), at(path, value)))
        else:
            moves += [(f.getPath().toString(), f"{at(path, value)}/{f.getPath().getName()}") for f in fs.listStatus(folder)]
    fs.mkdirs(make(path))
    _swap(spark, path, moves, staged, [aside, staged])


def purge_before(spark: SparkSession, path: str, part_col: str, cutoff: date) -> None:
    """Drop whole partitions dated before ``cutoff``."""
    fs, make = _fs(spark, path)
    for value, folder in _partitions(fs, make, path, part_col).items():
        day = _day(value)
        if day is not None and day < cutoff:
            fs.delete(folder, True)


def align_to(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of the target by name (case-blind): missing ones NULL, extra ones dropped, target order."""
    have = {c.lower(): c for c in df.columns}
    return df.select(*[
        (F.col(f"`{have[f.name.lower()]}`") if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema
    ])


def _fitted(df: DataFrame, path: str, partition_by: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Rows in the target's columns and the target's partition columns; as given where there is no target."""
    spark = df.sparkSession
    if not exists(spark, path):
        return df, list(partition_by)
    parts = layout(spark, path)
    if partition_by and list(partition_by) != parts:
        raise ValueError(f"{path} is partitioned by {parts}, not by {list(partition_by)}")
    return align_to(df, spark.read.parquet(path).schema), parts


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Add rows, aligned by name to the target and in its partition folders when it exists."""
    recover(df.sparkSession, path)
    rows, parts = _fitted(df, path, partition_by)
    rows.write.mode("append").partitionBy(*parts).parquet(path)


def append_nonempty(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> bool:
    """Append unless there is nothing to append. The plan runs once, into the shared folder."""
    rows = stage(df, "append")
    filled = not rows.isEmpty()
    if filled:
        append(rows, path, partition_by)
    unstage(rows)
    return filled


def unmatched(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key is not in the target; duplicates inside the source all stay.

    The target is cut down to the source's keys first. If those are few they are broadcast and a huge
    target is only scanned, never shuffled; otherwise both joins share one partitioning of the target.
    """
    keys = list(keys)
    present = target.select(*keys).join(source.select(*keys).distinct(), keys, "left_semi")
    return source.join(present, keys, "left_anti").select(*source.columns)


def merge_insert_only(source: DataFrame, path: str, keys: Sequence[str], partition_by: Sequence[str] = ()) -> None:
    """Insert-only MERGE: keys already in the target are left alone. Keys must not be NULL."""
    spark = source.sparkSession
    recover(spark, path)
    if exists(spark, path):
        source = unmatched(stage(source, "merge_source"), spark.read.parquet(path), keys)
    append(source, path, partition_by)


def new_rows(source: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key is not in the bucketed table ``name``, keys as the table has them.

    The table is bucketed by the merge key, so only the source is shuffled, into the table's buckets. The hint keeps the
    table out of a broadcast, whatever its size.
    """
    target = source.sparkSession.table(name)
    keys = list(keys)
    rows = source.withColumns({k: F.col(k).cast(target.schema[k].dataType) for k in keys})
    return rows.join(target.select(*keys).hint("merge"), keys, "left_anti").select(*rows.columns)


def merge_into_buckets(source: DataFrame, name: str, keys: Sequence[str], buckets: int,
                       finish: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> None:
    """Insert-only MERGE into a catalog table bucketed by the merge key; the first load creates it.

    A target that grows with every run is then never shuffled: its buckets are read where they lie, without the columns
    beyond the key. A task writes one file, for the bucket it has compared. Keys must not be NULL. ``finish`` makes the
    table's columns from the source's, key included, for the rows that are added; what it makes is not shuffled.
    """
    keys = list(keys)
    if source.sparkSession.catalog.tableExists(name):
        rows = align_to(finish(new_rows(source, name, keys)), source.sparkSession.table(name).schema)
    else:
        rows = finish(source.repartition(buckets, *keys))
    rows.write.mode("append").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)


def insert_into(df: DataFrame, name: str) -> None:
    """Add rows to a catalog table, aligned by name to the schema that the catalog holds for it."""
    align_to(df, df.sparkSession.table(name).schema).write.insertInto(name)


def load_stamps(df: DataFrame, at: datetime, by: str) -> DataFrame:
    return df.withColumns({"createddate": F.lit(at).cast("timestamp"), "createdby": F.lit(by)})


def save_report(df: DataFrame, name: str) -> None:
    df.write.mode("overwrite").saveAsTable(name)
