"""Column references by exact name: signal names may contain dots, spaces or backticks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def exact(name: str) -> Column:
    return F.col(quoted(name))
