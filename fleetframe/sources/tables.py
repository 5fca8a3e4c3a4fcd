"""Parquet tables: typed-empty reads, appends, replacements and partition-wise overwrites.

A replacement never deletes what it replaces before the new files are complete. A whole table is written next to
the old one, the old folder is set aside, the new one takes its name, and only then the old one goes. If
that is interrupted, readers take the folder set aside.

Partitions are replaced by a commit. The new files of all of them are staged in a hidden folder of the table; then a
record that lists the partitions appears, in one move; then the staged folders take the places of the old ones, one by
one; at last the record goes. Before the record stands, readers see the old rows, afterwards the new ones, also while
folders are moved and after an interruption at any point: a partition whose staged folder is still there is read from it.
The next writer finishes what is recorded and removes what was only staged. A table has one writer at a time.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FORMATS = {"parquet"}
# Folder of the state before an unfinished replacement, behind the table's name.
BEFORE = "__before"
# Hidden folders of a table: partitions being written, and the records of commits that are not finished.
STAGED, COMMITS = "_staged-", "_commits"


class Folder:
    """A folder of a table in whatever store its path names."""

    def __init__(self, spark: SparkSession, path: str):
        context = spark.sparkContext
        self.path = path.rstrip("/")
        self._path = context._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(context._jsc.hadoopConfiguration())

    def exists(self, path: str | None = None) -> bool:
        return self._fs.exists(self._path(path or self.path))

    def delete(self, path: str | None = None) -> None:
        self._fs.delete(self._path(path or self.path), True)

    def size(self) -> int:
        """Bytes of all files below."""
        return self._fs.getContentSummary(self._path(self.path)).getLength()

    def move(self, source: str, target: str) -> None:
        self._fs.mkdirs(self._path(target).getParent())
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"could not move {source} to {target}")

    def folders(self) -> list[str]:
        """Names of the folders below."""
        return sorted(name for name, is_folder in self._entries(self.path) if is_folder)

    def files(self, path: str) -> list[str]:
        return sorted(name for name, is_folder in self._entries(path) if not is_folder)

    def _entries(self, path: str) -> list[tuple[str, bool]]:
        if not self.exists(path):
            return []
        return [(f.getPath().getName(), f.isDirectory()) for f in self._fs.listStatus(self._path(path))]

    def partitions(self, root: str | None = None) -> list[str]:
        """The partitions (`a=1/b=2`) below a folder, by the folders that hold no further partition."""
        root, found = root or self.path, []

        def walk(part: str) -> None:
            below = [name for name, is_folder in self._entries(f"{root}/{part}") if is_folder and "=" in name]
            if not below and part:
                found.append(part)
            for name in below:
                walk(f"{part}/{name}".lstrip("/"))

        walk("")
        return sorted(found)

    def write(self, path: str, text: str) -> None:
        out = self._fs.create(self._path(path), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def read(self, path: str) -> str:
        source = self._fs.open(self._path(path))
        try:
            return bytes(source.readAllBytes()).decode()
        finally:
            source.close()


@dataclass(frozen=True)
class Commit:
    """Partitions that a staged folder replaces, and those that go without a successor."""

    id: str
    replaced: list[str] = field(default_factory=list)
    dropped: list[str] = field(default_factory=list)

    def staged(self, table: str) -> str:
        return f"{table}/{STAGED}{self.id}"

    def record(self, table: str) -> str:
        return f"{table}/{COMMITS}/{self.id}.json"


def _unfinished(folder: Folder) -> list[Commit]:
    names = folder.files(f"{folder.path}/{COMMITS}")
    return [Commit(**json.loads(folder.read(f"{folder.path}/{COMMITS}/{name}"))) for name in names if name.endswith(".json")]


def _finish(folder: Folder, commit: Commit) -> None:
    """Move what is still staged; may be repeated."""
    table = folder.path
    for part in commit.replaced:
        if folder.exists(f"{commit.staged(table)}/{part}"):
            folder.delete(f"{table}/{part}")
            folder.move(f"{commit.staged(table)}/{part}", f"{table}/{part}")
    for part in commit.dropped:
        folder.delete(f"{table}/{part}")
    folder.delete(commit.staged(table))
    folder.delete(commit.record(table))


def recover(spark: SparkSession, path: str) -> None:
    """Finish recorded commits of a table and remove what was staged without a record. Writers do this first."""
    folder = Folder(spark, path)
    for commit in _unfinished(folder):
        _finish(folder, commit)
    for name in folder.folders():
        if name.startswith(STAGED):
            folder.delete(f"{folder.path}/{name}")


def _replace_partitions(spark: SparkSession, path: str, stage, dropped: list[str] | None = None) -> None:
    """`stage(folder)` writes new partitions into a hidden folder; a commit lets them replace those of the table."""
    recover(spark, path)
    folder, commit = Folder(spark, path), Commit(uuid.uuid4().hex)
    staged = commit.staged(folder.path)
    try:
        stage(staged)
        replaced = folder.partitions(staged)
        commit = Commit(commit.id, replaced, [p for p in dropped or [] if p not in replaced])
        draft = f"{folder.path}/{COMMITS}/{commit.id}.draft"
        folder.write(draft, json.dumps({"id": commit.id, "replaced": commit.replaced, "dropped": commit.dropped}))
    except BaseException:
        folder.delete(staged)
        raise
    folder.move(draft, commit.record(folder.path))
    _finish(folder, commit)


def _swap(spark: SparkSession, write, path: str, new: str, before: str) -> None:
    """`write(new)`, then let `new` take the place of `path`."""
    folder = Folder(spark, path)
    try:
        write(new)
    except BaseException:
        folder.delete(new)
        raise
    if folder.exists():
        folder.delete(before)
        folder.move(folder.path, before)
    folder.move(new, folder.path)
    folder.delete(before)


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Read a table. A missing one is an empty frame with `schema`."""
    reader, before = spark.read if schema is None else spark.read.schema(schema), path.rstrip("/") + BEFORE
    folder = Folder(spark, path)
    if not folder.exists():
        if Folder(spark, before).exists():
            return reader.parquet(before)
        if schema is not None:
            return spark.createDataFrame([], schema)
    unfinished = _unfinished(folder)
    return _resolved(folder, reader, unfinished, schema) if unfinished else reader.parquet(path)


def _resolved(folder: Folder, reader, unfinished: list[Commit], schema: T.StructType | str | None) -> DataFrame:
    """A table with unfinished commits, as it is once they are finished."""
    staged = {commit.staged(folder.path): [p for p in commit.replaced if folder.exists(f"{commit.staged(folder.path)}/{p}")]
              for commit in unfinished}
    hidden = {p for parts in staged.values() for p in parts} | {p for commit in unfinished for p in commit.dropped}
    roots = {folder.path: [p for p in folder.partitions() if p not in hidden]} | staged
    found = [reader.option("basePath", root).parquet(*[f"{root}/{p}" for p in parts]) for root, parts in roots.items() if parts]
    if not found:
        return reader.parquet(folder.path).limit(0) if schema is None else reader.schema(schema).parquet(folder.path).limit(0)
    return reduce(lambda a, b: a.unionByName(b), found)


def read_evolving(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a table that gained columns over time: all columns of all files, at least `schema`."""
    if not Folder(spark, path).exists():
        return spark.createDataFrame([], schema)
    try:
        return spark.read.option("mergeSchema", True).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return spark.createDataFrame([], schema)


def write_table(df: DataFrame, path: str, mode: str = "error", partition_by: list[str] | None = None,
                fmt: str = "parquet") -> None:
    """Write Parquet with Snappy; other formats are rejected. `overwrite` keeps the old rows until the new are complete."""
    if fmt not in FORMATS:
        raise ValueError(f"unsupported format: {fmt}")
    if mode == "overwrite":
        own = path.rstrip("/")
        _swap(df.sparkSession, lambda new: write_table(df, new, "error", partition_by), own,
              f"{own}__next-{uuid.uuid4().hex}", own + BEFORE)
        return
    writer = df.write.mode(mode).option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def append_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Append rows; with partition columns, few files per partition."""
    recover(df.sparkSession, path)
    rows = df.hint("rebalance", *partition_by) if partition_by else df
    write_table(rows, path, "append", partition_by)


def replace_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Overwrite a table that `df` may itself be reading."""
    write_table(df, path, "overwrite", partition_by)


def replace_partition(df: DataFrame, path: str, partition: dict[str, str]) -> None:
    """Replace one partition, also by no rows at all. `df` has the other columns and may read the table."""
    where = _part(partition)
    _replace_partitions(df.sparkSession, path, lambda staged: write_table(df.drop(*partition), f"{staged}/{where}"))


def drop_partition(spark: SparkSession, path: str, partition: dict[str, str]) -> None:
    recover(spark, path)
    Folder(spark, f"{path.rstrip('/')}/{_part(partition)}").delete()


def _part(partition: dict[str, str]) -> str:
    return "/".join(f"{name}={value}" for name, value in partition.items())


def table_names(spark: SparkSession, root: str, prefix: str = "") -> list[str]:
    """Tables below a folder."""
    return [name for name in Folder(spark, root).folders() if name.startswith(prefix) and "__" not in name]


def overwrite_partitions(df: DataFrame, path: str, partition_by: list[str], rebalance: bool = True,
                         emptied: list[dict[str, str]] | None = None) -> None:
    """Replace only the partitions that `df` has rows for, and remove those of `emptied` that it has none for.

    `df` may read the same table. All partitions change together (see the module). Rebalancing gives few files per
    partition, and adaptive execution splits a large one; it is a shuffle, so leave it out when all rows belong to one
    partition anyway.
    """
    rows = df.hint("rebalance", *partition_by) if rebalance else df
    _replace_partitions(df.sparkSession, path, lambda staged: write_table(rows, staged, "error", partition_by),
                        [_part(p) for p in emptied or []])


def of_dates(df: DataFrame, column: str, dates: list) -> DataFrame:
    """Rows of the given dates; None among them stands for rows without a date. Prunes partitions."""
    known = [d for d in dates if d is not None]
    wanted = F.col(column).isin(known)
    return df.filter(wanted | F.col(column).isNull() if len(known) < len(dates) else wanted)


def export_pivot(df: DataFrame, path: str) -> None:
    """Export of the wide table; as many files as there are partitions."""
    write_table(df, path, "overwrite")


def matching_summaries(df: DataFrame, pattern: str, column: str = "summary_date") -> DataFrame:
    """Rows whose `yyyyMMdd` summary date matches a glob such as `2025*` (prunes partitions)."""
    like = pattern.replace("%", r"\%").replace("_", r"\_").replace("*", "%").replace("?", "_")
    return df.filter(F.col(column).like(like))


def read_summaries(spark: SparkSession, path: str, pattern: str, schema: T.StructType) -> DataFrame:
    """All daily summaries whose date matches `pattern`."""
    with_date = T.StructType([*schema.fields, T.StructField("summary_date", T.StringType())])
    return matching_summaries(read_table(spark, path, with_date), pattern)
