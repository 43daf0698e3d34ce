"""Order, identity and set operators that the others build on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key in the given order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def top_per(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows of each key, ranked from 1."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(rank) <= k)


def numbered_rows(df: DataFrame, name: str, order: str = "ord", chunk: int = 1_000_000) -> DataFrame:
    """Rows numbered from 1 in the order of an integer column (W05), without sorting all rows in one task.

    Rows are numbered within chunks of the order's values; the chunks' sizes, one row a chunk, are summed before them.
    """
    chunked = df.withColumn("_chunk", F.floor(F.col(order) / chunk))
    sizes = chunked.groupBy("_chunk").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_chunk", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_chunk").orderBy(order))
    return chunked.withColumn("_n", within).join(starts, "_chunk").withColumn(name, F.col("_n") + F.col("_before")).drop("_chunk", "_n", "_before")


def distinct_in_order(df: DataFrame, key: str, order: str = "ord") -> DataFrame:
    """Distinct values by first appearance."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(order).alias(order))


def ordered_list(value: str | Column, *order: str | Column) -> Column:
    """Aggregate: values of a group as an array in an order."""
    value = F.col(value) if isinstance(value, str) else value
    return F.transform(F.array_sort(F.collect_list(F.struct(*order, value.alias("_v")))), lambda x: x["_v"])


def without_other(df: DataFrame, columns: Sequence[str] = ("topic", "opinion")) -> DataFrame:
    """Rows whose topic and opinion aren't ``Other``; missing ones stay."""
    for c in columns:
        df = df.where(~F.col(c).eqNullSafe("Other"))
    return df


def all_equal(df: DataFrame, values: dict) -> DataFrame:
    """Rows that equal every given value."""
    for k, v in values.items():
        df = df.where(F.col(k) == v)
    return df


def drop_all_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """P13"""
    return df.na.drop(how="all", subset=list(columns))


def full_outer(a: DataFrame, b: DataFrame, key: str, suffixes: tuple[str, str] | None = None, indicator: str | None = None) -> DataFrame:
    """Full outer join on a key (J01), with suffixes for columns of both (J03) and an indicator of the side."""
    if suffixes:
        both = (set(a.columns) & set(b.columns)) - {key}
        a, b = (d.withColumnsRenamed({c: c + s for c in both}) for d, s in zip((a, b), suffixes))
    if indicator:
        a, b = a.withColumn("_a", F.lit(True)), b.withColumn("_b", F.lit(True))
    joined = a.join(b, key, "full_outer")
    if indicator:
        side = F.when(F.col("_a") & F.col("_b"), "both").when(F.col("_a"), "left_only").otherwise("right_only")
        joined = joined.withColumn(indicator, side).drop("_a", "_b")
    return joined


def validated_one_to_one(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Left join in which a key that repeats on either side raises."""
    for side, d in (("left", a), ("right", b)):
        if d.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1").limit(1).count():
            raise ValueError(f"{key} repeats on the {side}")
    return a.join(b, key, "left")


def coalesced(frames: Sequence[DataFrame], key: str) -> DataFrame:
    """Union of keys; each column from the first frame that has a value."""
    columns = list(dict.fromkeys(c for d in frames for c in d.columns if c != key))
    every = None
    for i, d in enumerate(frames):
        one = d.withColumn("_at", F.lit(i))
        every = one if every is None else every.unionByName(one, allowMissingColumns=True)
    return every.groupBy(key).agg(*(F.min_by(c, F.when(F.col(c).isNotNull(), F.col("_at"))).alias(c) for c in columns))


def looked_up(a: DataFrame, b: DataFrame, on: str, bound: int = 100_000) -> DataFrame:
    """Left join with a lookup table (J16), broadcast only while it has at most ``bound`` rows."""
    small = b.limit(bound + 1).count() <= bound
    return a.join(F.broadcast(b) if small else b, on, "left")


def appended_if_absent(c: Column, value: Column) -> Column:
    """U02"""
    return F.when(F.array_contains(c, value), c).otherwise(F.concat(c, F.array(value)))


def unioned(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; missing columns are null."""
    out = frames[0]
    for d in frames[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def distinct_texts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct non-blank texts of several columns."""
    return df.select(F.explode(F.array(*columns)).alias("text")).where("trim(text) <> ''").distinct()


def row_mean(columns: Sequence[str]) -> Column:
    """Mean of a row's values, nulls and NaN left out."""
    kept = F.filter(F.array(*(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in columns)), lambda x: x.isNotNull())
    return F.try_divide(F.aggregate(kept, F.lit(0.0), lambda a, x: a + x), F.size(kept))


def row_max(columns: Sequence[str]) -> Column:
    """Largest of a row's values, nulls and NaN left out."""
    return F.greatest(*(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in columns))
