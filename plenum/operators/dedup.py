"""De-duplication of propositions across topics: equivalence sets, the rank-filling draft, winning topics."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .basics import top_per
from .similar import similar_sets

__all__ = ["draft", "has_selected", "lowest_rank", "members", "rank_filling", "ranking_column", "similar_sets", "winning_topics", "with_ids"]


def with_ids(propositions: DataFrame) -> DataFrame:
    """Ids ``topic:index`` (G13, O11): topics numbered by their number of first-round quotes, propositions as they stand.

    ``propositions``: topic, r1_quotes, idx, proposition, rank.  Topics are few; their numbering is one small window.
    """
    topics = propositions.groupBy("topic").agg(F.max("r1_quotes").alias("r1_quotes"))
    numbered = topics.withColumn("topic_id", F.row_number().over(Window.orderBy(F.desc("r1_quotes"), "topic")) - 1).drop("r1_quotes")
    with_topic = propositions.join(numbered, "topic")
    return with_topic.withColumn("proposition_id", F.concat_ws(":", F.col("topic_id").cast("string"), F.col("idx").cast("string")))


def members(sets: DataFrame) -> DataFrame:
    """(set_id, proposition_id) of equivalence sets with two members or more."""
    return sets.where("size(members) >= 2").select("set_id", F.explode("members").alias("proposition_id"))


def lowest_rank(group: list[dict]) -> str:
    """Judge that prefers the best rank, then the id."""
    return min(group, key=lambda p: (p["rank"], p["proposition_id"]))["proposition_id"]


def draft(rows: list[dict], n: int, judge: Callable[[list[dict]], str] = lowest_rank) -> list[dict]:
    """Rank-filling draft of one group (G12): in each round every topic still short offers its best proposition left.

    Offers of the same equivalence set collide; the judge keeps one, the topics of the others offer again in that round.  A
    set is closed once one of it is taken.  Every member of a set is marked as a duplicate, the one that was kept too.
    """
    by_topic: dict[str, list[dict]] = {}
    for r in sorted(rows, key=lambda r: (r["topic_id"], r["rank"], r["proposition_id"])):
        r |= {"selected": False, "duplicate": r["set_id"] is not None, "lost": False}
        by_topic.setdefault(r["topic"], []).append(r)
    closed: set = set()
    for k in range(1, n + 1):
        short = [t for t, own in by_topic.items() if sum(r["selected"] for r in own) < k]
        while short:
            offers: dict = {}
            for t in short:
                for r in by_topic[t]:
                    if not r["selected"] and not r["lost"]:
                        if r["set_id"] is not None and r["set_id"] in closed:
                            r["lost"] = True
                            continue
                        offers[t] = r
                        break
            short = []
            groups: dict = {}
            for t, r in offers.items():
                groups.setdefault(("set", r["set_id"]) if r["set_id"] is not None else ("own", r["proposition_id"]), []).append((t, r))
            for (kind, name), group in groups.items():
                winner = judge([r for _, r in group]) if len(group) > 1 else group[0][1]["proposition_id"]
                for t, r in group:
                    r["selected"] = r["proposition_id"] == winner
                    r["lost"] = not r["selected"]
                    if r["lost"]:
                        short.append(t)
                if kind == "set":
                    closed.add(name)
    return rows


def rank_filling(propositions: DataFrame, sets: DataFrame, n: int, by: str | None = None) -> DataFrame:
    """The draft over all topics (G12, G16), or apart for each value of ``by``; state is one pick after another by nature."""
    columns = ["topic", "topic_id", "proposition_id", "proposition", "rank", "set_id"]
    listed = propositions.join(members(sets).groupBy("proposition_id").agg(F.min("set_id").alias("set_id")), "proposition_id", "left")
    grouped = listed.withColumn("_by", F.col(by).cast("string") if by else F.lit(""))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = pdf.astype(object).where(pdf.notna(), None).to_dict("records")
        return pd.DataFrame(draft(rows, n))[["_by", "topic", "proposition_id", "proposition", "selected", "duplicate"]]

    out = grouped.select("_by", *columns).groupBy("_by").applyInPandas(run, "_by string, topic string, proposition_id string, proposition string, selected boolean, duplicate boolean")
    return out.withColumnRenamed("_by", by) if by else out.drop("_by")


def winning_topics(propositions: DataFrame, sets: DataFrame, n: int) -> DataFrame:
    """Topic-wise de-duplication (G17): of each set the topic with the best rank keeps its own, the others are duplicates; then the first ``n`` of each topic."""
    listed = propositions.join(members(sets), "proposition_id", "left")
    best = listed.where("set_id IS NOT NULL").groupBy("set_id").agg(F.min_by("topic", F.struct("rank", "topic_id")).alias("winner"))
    judged = listed.join(best, "set_id", "left").groupBy("topic", "proposition_id", "proposition", "rank").agg(F.bool_or(F.coalesce(F.col("winner") != F.col("topic"), F.lit(False))).alias("duplicate"))
    kept = top_per(judged.where("NOT duplicate"), ["topic"], [F.col("rank"), F.col("proposition_id")], n, "place").select("topic", "proposition_id", F.lit(True).alias("selected"))
    return judged.join(kept, ["topic", "proposition_id"], "left").withColumn("selected", F.coalesce("selected", F.lit(False)))


def has_selected(propositions: DataFrame) -> bool:
    """Whether any proposition is selected yet."""
    return bool(propositions.agg(F.bool_or("selected")).first()[0])


def ranking_column(columns: list[str]) -> str:
    """The approval ranking if there is one, else the Schulze ranking."""
    for c in ("full_pav_ranking", "full_schulze_ranking"):
        if c in columns:
            return c
    raise ValueError("there is no ranking column")
