"""Named queries over a run's tables (Q01 to Q12).

A run has, by level (opinion, topic, nuanced): ``propositions(level, topic, opinion, proposition, selected, idx)``,
``rankings(level, topic, opinion, method, ranking)`` with method ``schulze`` or ``pav``, ``approvals`` (long votes),
``participants(round, participant_id, ...)``, ``simulation_results``, ``jury_stats``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .basics import first_per, full_outer, unioned
from .social_choice import approval_rates

KEYS = ["topic", "opinion"]


def positions(rankings: DataFrame, method: str, name: str) -> DataFrame:
    """Rank of each proposition from 1 (W02); of a repeated one the last place holds."""
    rows = rankings.where(F.col("method") == method).select("level", *KEYS, F.posexplode("ranking").alias("p", "proposition"))
    return rows.groupBy("level", *KEYS, "proposition").agg((F.max("p") + 1).cast("bigint").alias(name))


def ranked_propositions(propositions: DataFrame, rankings: DataFrame, votes: DataFrame, level: str) -> DataFrame:
    """Propositions of a level with both ranks, the approval rate, and the primary rank: PAV where the group has it, else Schulze."""
    own = propositions.where(F.col("level") == level)
    ranks = rankings.where(F.col("level") == level)
    names = ("level", *KEYS, "proposition")
    out = own
    for method in ("schulze", "pav"):
        p = positions(ranks, method, f"{method}_rank").withColumnsRenamed({c: f"_{c}" for c in names})
        same = F.lit(True)
        for c in names:
            same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
        out = out.join(p, same, "left").drop(*(f"_{c}" for c in names))
    has = ranks.where("method = 'pav'").select(*(F.col(c).alias(f"_{c}") for c in KEYS)).distinct().withColumn("_pav", F.lit(True))
    out = out.join(has, F.col("topic").eqNullSafe(F.col("_topic")) & F.col("opinion").eqNullSafe(F.col("_opinion")), "left").drop("_topic", "_opinion")
    rates = approval_rates(votes)
    return out.join(rates, "proposition", "left").withColumn("rank", F.when(F.col("_pav"), F.col("pav_rank")).otherwise(F.col("schulze_rank"))).drop("_pav")


def _top(df: DataFrame, n: int | None) -> DataFrame:
    return df.where(F.col("rank") <= n) if n else df


def selected_by_opinion(p: DataFrame, r: DataFrame, v: DataFrame, top_n: int | None = None) -> DataFrame:
    """Q01, and Q08 without a limit."""
    return _top(ranked_propositions(p, r, v, "opinion").where("rank IS NOT NULL"), top_n)


def selected_by_topic(p: DataFrame, r: DataFrame, v: DataFrame, top_n: int | None = None) -> DataFrame:
    """Q02: those that de-duplication selected."""
    return _top(ranked_propositions(p, r, v, "topic").where("selected"), top_n)


def selected_nuanced(p: DataFrame, r: DataFrame, v: DataFrame, top_n: int | None = None) -> DataFrame:
    """Q03"""
    chosen = ranked_propositions(p, r, v, "nuanced").where("selected").withColumn("topic", F.lit("Nuanced"))
    return _top(chosen.withColumn("rank", (F.col("idx") + 1).cast("bigint")), top_n)


def selected_propositions(p: DataFrame, r: DataFrame, v: DataFrame, topics: int | None = None, nuanced: int | None = None) -> DataFrame:
    """Q04"""
    return unioned([selected_by_topic(p, r, v, topics), selected_nuanced(p, r, v, nuanced)])


def participant_data(r1: DataFrame, r2: DataFrame, source: str = "both") -> DataFrame:
    """Q05: each participant's first row of a round, or of both side by side."""
    a, b = (first_per(d, ["participant_id"], ["ord"]).drop("ord") for d in (r1, r2))
    if source == "both":
        return full_outer(a, b, "participant_id", ("_r1", "_r2"))
    return {"r1": a, "r2": b}[source]


def simulation_results(df: DataFrame, aggregation: str = "by_topic") -> DataFrame:
    """Q06: results by topic, or of all topics together."""
    return df if aggregation == "by_topic" else df.drop("topic")


def failed_tries(df: DataFrame) -> DataFrame:
    """Q07"""
    return df.select("level", "topic", "participant_id", F.explode("failed_tries").alias("f")).select("level", "topic", "participant_id", "f.*")


def all_by_topic(p: DataFrame, r: DataFrame, v: DataFrame) -> DataFrame:
    """Q09"""
    return ranked_propositions(p, r, v, "topic")


def all_nuanced(p: DataFrame, r: DataFrame, v: DataFrame) -> DataFrame:
    """Q10: the primary method is the one whose first places are those that were selected, PAV if both or neither are."""
    rows = ranked_propositions(p, r, v, "nuanced")
    agrees = rows.where("selected").agg(F.bool_and((F.col("idx") + 1).eqNullSafe(F.col("pav_rank"))).alias("pav"), F.bool_and((F.col("idx") + 1).eqNullSafe(F.col("schulze_rank"))).alias("schulze")).first()
    method = "schulze" if agrees["schulze"] and not agrees["pav"] else "pav"
    return rows.withColumn("rank", F.col(f"{method}_rank")).withColumn("method", F.lit(method)).orderBy(F.asc_nulls_last("rank"), "proposition")


def jury_stats(spark, root: str) -> DataFrame:
    """Q11: the stored statistics; a run without any raises."""
    return spark.read.parquet(f"{root}/jury_stats")


def nested(df: DataFrame, path: str) -> DataFrame:
    """A field by its dotted path."""
    return df.select(F.col(path).alias(path.rpartition(".")[2]))


def run_statistics(jobs: DataFrame) -> DataFrame:
    """Counts, shares and sums over a jury's jobs."""
    failed = F.count_if(F.col("status") != "ok")
    return jobs.groupBy("topic").agg(
        F.count("*").alias("jobs"), failed.alias("failed"), F.try_divide(failed * 100.0, F.count("*")).alias("failed_percent"),
        F.try_divide(F.sum("seconds"), F.count("*")).alias("seconds_a_job"), F.sum(F.length("prompt")).alias("characters"), F.sum("tokens").alias("tokens"),
    )


def rate_error(rate: Column, truth: Column) -> Column:
    """Approval rate less the true one, as percentage points (F16)."""
    return F.format_string("%.1f%%", (rate - truth) * 100)
