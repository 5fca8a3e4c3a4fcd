"""Helpers shared by the operators: row keys, Arrow blocks, the crc32 folds of the contracts."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetframe.session import ship, work_path
from fleetframe.sources.tables import Folder

BLOCK_CHARS = 4_000_000
BROADCAST_BYTES = 32 * 1024 * 1024


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


#: Spark's setting of the bytes of an Arrow batch, 64 MB by itself: several such batches, in the JVM and in its Python
#: workers, with what the allocators keep of them, are a large part of an executor.
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of this session hold about a block of text; a size that the caller has set stays."""
    size = f"{BLOCK_CHARS}b"
    if spark.conf.get(BATCH_SETTING, size) == size:
        spark.conf.set(BATCH_SETTING, size)


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """mapInArrow with this package on the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


#: Paths of staged tables by scope, the innermost last; those of no scope stay until `release` or the end.
_SCOPES: list[set[str]] = [set()]


def staged(df: DataFrame, name: str) -> DataFrame:
    """`df` written once below the session's shared folder and read back: computed once, lineage cut."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return _staged_at(df.sparkSession, path, df.schema)


def _staged_at(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    made = spark.read.schema(schema).parquet(path)
    made._staged_path = path
    _SCOPES[-1].add(path)
    return made


def _delete(spark: SparkSession, paths: Iterable[str]) -> None:
    for path in paths:
        Folder(spark, path).delete()


def unstage(*frames: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for df in frames:
        path = getattr(df, "_staged_path", None)
        for scope in _SCOPES:
            if path in scope:
                scope.remove(path)
                _delete(df.sparkSession, [path])


#: Staged tables up to this size on disk are small; what is derived from one is written by so many tasks.
SMALL_BYTES, SMALL_PARTS = 1024 * 1024, 8


def few(*frames: DataFrame) -> bool:
    """Whether the staged tables are small, by the size of their files."""
    return sum(Folder(df.sparkSession, df._staged_path).size() for df in frames) <= SMALL_BYTES


def gathered(df: DataFrame, small: bool) -> DataFrame:
    """`df` in a few partitions if it is `small`: adaptive execution does so by itself unless it is told not to."""
    return df.coalesce(SMALL_PARTS) if small else df


def settled(spark: SparkSession, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The frame that `make` returns, written and read back; what was staged on the way there is deleted.

    The driver's collector is asked to run, as Spark itself does from time to time: the shuffle files of the plans that
    are through go with them.
    """
    _SCOPES.append(set())
    try:
        made = make()
        path = work_path(spark, name)
        made.write.parquet(path)
        schema = made.schema
    finally:
        _delete(spark, _SCOPES.pop())
    del made
    collect_plans(spark)
    return _staged_at(spark, path, schema)


def collect_plans(spark: SparkSession) -> None:
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def release(spark: SparkSession) -> None:
    """Delete all staged tables. For a caller who has written the results of the operators used so far."""
    for scope in _SCOPES:
        _delete(spark, scope)
        scope.clear()


def unused(df: DataFrame, name: str) -> str:
    """A column name that `df` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def named(df: DataFrame, *columns: str) -> list[Column]:
    """Columns of `df` by name, whatever characters the names hold."""
    return [df["`" + c.replace("`", "``") + "`"] for c in (columns or df.columns)]


def row_key(*columns: str) -> Column:
    """128 bits of the named columns: equal rows share a key, null columns are allowed."""
    return F.concat_ws("-", F.hex(F.xxhash64(*columns)), F.hex(F.xxhash64(F.lit("row"), *columns)))


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`; null for a null id, which belongs to no held-out part."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds


def in_fold(doc_id: str, folds: int, number: int) -> Column:
    return F.coalesce(fold(doc_id, folds) == number, F.lit(False))


_STATE: dict[tuple, object] = {}


def worker_state(key: tuple, make: Callable[[], object]) -> object:
    """What a Python worker keeps from task to task: the state of one operator, so that the stages of a
    pipeline, which share their workers, do not add up."""
    if key not in _STATE:
        _STATE.clear()
        gc.collect()
        _STATE[key] = make()
    return _STATE[key]


def text_blocks(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Record batches cut so that a block holds about BLOCK_CHARS bytes, one document at least."""
    for batch in batches:
        texts, start, size = batch.column(text), 0, 0
        for i in range(batch.num_rows):
            value = texts[i].as_buffer() if texts[i].is_valid else None
            size += value.size if value else 0
            if size >= BLOCK_CHARS:
                block = batch.slice(start, i + 1 - start)
                yield block, block.column(text).to_pylist()
                start, size = i + 1, 0
        if start < batch.num_rows:
            block = batch.slice(start)
            yield block, block.column(text).to_pylist()


def per_text(df: DataFrame, keep: list[str], text: str, schema: str,
             worker: Callable[[list[str | None]], dict[str, list]]) -> DataFrame:
    """One row out per row in: the `keep` columns and what `worker` returns for a block of texts.

    `schema` lists the worker's columns in DDL. Only the named columns reach the Python worker; other
    columns of `df`, whatever their names, do not take part.
    """
    spark = df.sparkSession
    made = spark.createDataFrame([], schema).schema
    source = df.select(*[F.col(c) for c in keep], F.col(text).cast("string").alias("_text"))
    out = source.select(*keep).schema
    for field in made:
        out = out.add(field.name, field.dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(out)
        for block, texts in text_blocks(batches, "_text"):
            values = worker(texts)
            arrays = [block.column(c).cast(target.field(c).type) for c in keep]
            arrays += [pa.array(values[f.name], type=target.field(f.name).type) for f in made]
            yield pa.RecordBatch.from_arrays(arrays, schema=target)

    small_batches(spark)
    return map_arrow(source, run, out)
