"""Sources: CSV exports, taxonomies, JSON documents and the run folder's Parquet tables.

Every scan keeps the file's order in ``ord`` where later steps speak of first rows.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CSV = {"header": True, "multiLine": True, "quote": '"', "escape": '"'}


def deduplicated_names(names: Sequence[str]) -> list[str]:
    """Repeated headers get ``_1``, ``_2`` and so on."""
    seen: dict[str, int] = {}
    out = []
    for n in names:
        k = seen[n] = seen.get(n, -1) + 1
        out.append(f"{n}_{k}" if k else n)
    return out


def _raw(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text under their own names, header included as the first row of each file; ``ord`` is the row's place over
    all files, ``line`` its place in its file."""
    options = CSV | {"header": False}
    # A file of many lines a record can't be split, so ids follow the file's order.
    rows = spark.read.options(**options).csv(path).select("*", F.monotonically_increasing_id().alias("ord"), F.col("_metadata.file_path").alias("_file"))
    first = rows.groupBy("_file").agg(F.min("ord").alias("_first"))  # one row a file
    return rows.join(first, "_file").withColumn("line", F.col("ord") - F.col("_first")).drop("_file", "_first")


def header(spark: SparkSession, path: str) -> list[str]:
    """Column names alone (S05), of the first file."""
    first = spark.read.options(**(CSV | {"header": False})).csv(path).limit(1).first()
    return [] if first is None else deduplicated_names([x or f"_c{i}" for i, x in enumerate(first)])


def read_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None, infer: bool = False) -> DataFrame:
    """CSV scan: text columns, or inferred types (S01, S04); only ``columns``, if given; an absent one raises."""
    df = spark.read.options(**CSV, inferSchema=infer).csv(path)
    absent = [c for c in columns or () if c not in df.columns]
    if absent:
        raise ValueError(f"{path} has no column {', '.join(absent)}")
    return df.select(*(f"`{c}`" for c in columns)) if columns else df


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """All-text scan with lower-cased headers and the rows' order."""
    names = [n.lower() for n in header(spark, path)]
    return _raw(spark, path).where(F.col("line") > 0).drop("line").toDF(*deduplicated_names(names), "ord")


def read_export(spark: SparkSession, path: str, keep: Sequence[str] | None = None) -> tuple[DataFrame, dict[str, str]]:
    """A survey export: header, then a row of question texts, then another that is left out.

    Returns the answers (with ``ord``) and the question text of each column.
    """
    names = header(spark, path)
    rows = _raw(spark, path).toDF(*names, "ord", "line")
    texts = rows.where("line = 1").orderBy("ord").limit(1).first()
    answers = rows.where("line >= 3").withColumn("ord", F.col("ord") - 3)
    chosen = [n for n in names if keep is None or n in keep]
    return answers.select(*(f"`{c}`" for c in chosen), "ord"), {c: (texts[c] or "") if texts else "" for c in chosen}


def read_json(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """JSON documents of several lines."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def csv_as_json(df: DataFrame) -> DataFrame:
    """Rows as JSON objects."""
    return df.select(F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns if c != "ord")), {"ignoreNullFields": "false"}).alias("value"))


def additional_context(text: str | None = None, path: str | None = None, default: str | None = None, spark: SparkSession | None = None) -> str | None:
    """Context given as text or as a file, not both."""
    if text and path:
        raise ValueError("context is either text or a file")
    if path:
        return spark.read.text(path, wholetext=True).first()[0]
    return text or default


def taxonomy(df: DataFrame, ordered: bool = False) -> DataFrame:
    """(topic, opinions) from rows of both (S13); opinions sorted, or in order of appearance if the rows have ``ord``."""
    known = df.where("topic IS NOT NULL AND opinion IS NOT NULL")
    if not ordered:
        return known.groupBy("topic").agg(F.array_sort(F.collect_set("opinion")).alias("opinions"))
    first = known.groupBy("topic", "opinion").agg(F.min("ord").alias("o"))
    return first.groupBy("topic").agg(F.transform(F.array_sort(F.collect_list(F.struct("o", "opinion"))), lambda x: x["opinion"]).alias("opinions"))


def topics_argument(c: Column) -> Column:
    """Topics from a comma-separated text."""
    return F.filter(F.transform(F.split(c, ","), lambda x: F.trim(x)), lambda x: x != "")


def sheet_values(payload: str) -> tuple[list[str], list[list[str]]]:
    """Header and rows of a sheet's JSON answer (S09); fetching it is the caller's, there is no network here."""
    values = json.loads(payload).get("values", [])
    names = deduplicated_names(values[0]) if values else []
    return names, [[*row, *[""] * (len(names) - len(row))][: len(names)] for row in values[1:]]


def column_numbers(names: Sequence[str], pattern: str) -> list[int]:
    """Numbers in the names that match, sorted as numbers."""
    return sorted({int(m[1]) for n in names if (m := re.fullmatch(pattern, n))})


def write_table(df: DataFrame, root: str, name: str) -> None:
    """A run's table (S08, K03): Parquet below the run folder."""
    df.write.mode("overwrite").parquet(f"{root}/{name}")


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}")
