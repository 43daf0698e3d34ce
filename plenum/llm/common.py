"""Helpers that the training-data operators share."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialised as written
from ..session import small_batches, table
from ..session import work_dir as shared_dir

__all__ = ["LOWER", "UPPER", "ascii_lower", "shared_dir", "shuffle_width", "small_batches", "small_table", "table", "text_or_empty", "written"]

#: ASCII letters, for case folding that DuckDB and Python repeat exactly.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def small_table(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    """A table of a few rows as literals of the plan, so that no Python worker makes it."""
    fields = T.StructType.fromDDL(schema).fields
    structs = [F.struct(*(F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields))) for row in rows]
    if not structs:
        return spark.range(0).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in fields))
    return spark.range(1).select(F.inline(F.array(*structs)))


def shuffle_width(spark: SparkSession, least: int = 1) -> int:
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
