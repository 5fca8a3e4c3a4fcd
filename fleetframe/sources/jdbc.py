"""Database sink. Spark writes partitions in parallel, `batchsize` rows per statement."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame

log = logging.getLogger(__name__)

# Rows per batch (fixed value) and what to do with an existing table.
BATCH_ROWS = 10_000
MODES = {"replace": "overwrite", "append": "append", "fail": "error"}


def jdbc_options(table: str, batch_rows: int = BATCH_ROWS, connections: int = 16) -> dict[str, str]:
    """Writer options; `connections` bounds the parallel connections, not the parallelism of the job."""
    return {"dbtable": table, "batchsize": str(batch_rows), "numPartitions": str(connections)}


def write_jdbc(df: DataFrame, url: str, table: str, if_exists: str = "replace",
               batch_rows: int = BATCH_ROWS, properties: dict[str, str] | None = None) -> bool:
    """Write a frame; an empty one is reported and not written. Returns whether rows were written."""
    if if_exists not in MODES:
        raise ValueError(f"if_exists must be one of {sorted(MODES)}")
    if df.isEmpty():
        log.warning("no data to write to table %s", table)
        return False
    options = jdbc_options(table, batch_rows) | (properties or {})
    df.write.format("jdbc").mode(MODES[if_exists]).option("url", url).options(**options).save()
    return True
