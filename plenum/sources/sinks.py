"""Sinks: CSV, JSON and text outputs of a run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIRST_COLUMNS = ("participant_id", "survey_text", "quote", "quote_with_brackets", "topic", "opinion")


def ordered_columns(df: DataFrame, first: Sequence[str] = FIRST_COLUMNS) -> DataFrame:
    """Preferred columns first, the others sorted."""
    return df.select(*(F.col(f"`{c}`") for c in [*(c for c in first if c in df.columns), *sorted(c for c in df.columns if c not in first)]))


def present_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Those of the columns that there are."""
    return df.select(*(c for c in columns if c in df.columns))


def write_csv(df: DataFrame, path: str) -> None:
    ordered_columns(df).write.mode("overwrite").options(header=True, quote='"', escape='"').csv(path)


def flat_propositions(df: DataFrame) -> DataFrame:
    """One row per nested proposition, a placeholder row where there is none."""
    rows = df.select("topic", "opinion", F.explode_outer("propositions").alias("p"))
    return rows.select("topic", "opinion", F.coalesce("p.proposition", F.lit("No propositions found for this opinion.")).alias("proposition"))


def json_document(df: DataFrame) -> DataFrame:
    """All rows as one JSON array (K05); for results of report size."""
    return df.agg(F.to_json(F.collect_list(F.struct(*df.columns))).alias("value"))


def inline_payload(c: Column) -> Column:
    """JSON that may stand inside HTML."""
    return F.replace(c, F.lit("<"), F.lit("\\u003c"))


def write_result(df: DataFrame, path: str, kind: str = "csv", head: int | None = None) -> None:
    """A query's result as text, csv, json lines or Parquet, at most ``head`` rows."""
    df = df.limit(head) if head else df
    if kind == "csv":
        write_csv(df, path)
    elif kind in ("json", "jsonl"):
        df.write.mode("overwrite").json(path)
    elif kind == "text":
        df.select(card([c for c in df.columns]).alias("value")).write.mode("overwrite").text(path)
    elif kind == "parquet":
        df.write.mode("overwrite").parquet(path)
    else:
        raise ValueError(f"no such kind of output: {kind}")


def card(columns: Sequence[str], title: str | None = None) -> Column:
    """A row as lines ``name: value``, nulls left out."""
    lines = [F.when(F.col(f"`{c}`").isNotNull(), F.concat(F.lit(f"{c}: "), F.col(f"`{c}`").cast("string"))) for c in columns if c != title]
    head = [F.concat(F.lit("## "), F.col(f"`{title}`").cast("string"))] if title else []
    return F.concat_ws("\n", *head, *lines)


def grouped_cards(df: DataFrame, by: str, order: Sequence[str]) -> DataFrame:
    """Cards of a group under its heading, in order."""
    text = card([c for c in df.columns if c != by])
    rows = F.array_sort(F.collect_list(F.struct(*order, text.alias("card"))))
    return df.groupBy(by).agg(F.concat(F.lit("# "), F.first(F.col(by).cast("string")), F.lit("\n\n"), F.array_join(F.transform(rows, lambda x: x["card"]), "\n\n")).alias("text"))


def summary_and_rows(df: DataFrame, path: str) -> None:
    """An evaluation's mean and count, and its rows."""
    write_csv(df.groupBy("metric").agg(F.avg(F.col("score").try_cast("double")).alias("mean"), F.count("*").alias("n")), f"{path}/summary")
    write_csv(df, f"{path}/rows")


def abort_with_skipped(skipped: DataFrame, path: str) -> None:
    """Skipped rows are written, and stop the run."""
    n = skipped.count()
    if n:
        write_csv(skipped, path)
        raise ValueError(f"{n} rows were skipped; see {path}")
