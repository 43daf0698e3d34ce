"""Report data: counts of topics and opinions, demographics, comparison groups, hierarchies, samples."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .basics import first_per, ordered_list, without_other


def topic_tree(quotes: DataFrame) -> DataFrame:
    """Per topic and opinion its rows, beside the topic's distinct quotes and the place of both."""
    kept = without_other(quotes)
    opinions = kept.groupBy("topic", "opinion").agg(F.count("*").alias("opinion_quotes"), F.min("ord").alias("o"))
    topics = kept.groupBy("topic").agg(F.countDistinct("quote").alias("topic_quotes"), F.min("ord").alias("t"))
    joined = opinions.join(topics, "topic")
    # Few topics and opinions are left; their places are windows over that small table.
    return joined.select("topic", "opinion", "topic_quotes", "opinion_quotes",
        F.dense_rank().over(Window.orderBy(F.desc("topic_quotes"), "t", "topic")).cast("bigint").alias("topic_place"),
        F.row_number().over(Window.partitionBy("topic").orderBy(F.desc("opinion_quotes"), "o")).cast("bigint").alias("opinion_place"))


def topic_tree_text(quotes: DataFrame) -> DataFrame:
    """The tree as numbered, indented text."""
    tree = topic_tree(quotes)
    line = F.concat(F.lit("  "), F.col("opinion_place").cast("string"), F.lit(". "), F.col("opinion"), F.lit(" ("), F.col("opinion_quotes").cast("string"), F.lit(" quotes)"))
    head = F.concat(F.col("topic_place").cast("string"), F.lit(". "), F.col("topic"), F.lit(" ("), F.col("topic_quotes").cast("string"), F.lit(" quotes)"))
    blocks = tree.groupBy("topic_place", head.alias("head")).agg(F.concat_ws("\n", F.col("head"), F.array_join(ordered_list(line, "opinion_place"), "\n")).alias("block"))
    total = F.lit(tree.select("opinion").distinct().count()).cast("string")
    return blocks.agg(F.concat(F.array_join(ordered_list("block", "topic_place"), "\n\n"), F.lit("\n\nTotal number of unique opinions: "), total).alias("text"))


def rollup_counts(quotes: DataFrame) -> DataFrame:
    """Rows, participants and opinions of each opinion, of each topic and of all, in one pass."""
    said = F.when(F.coalesce(F.trim("quote"), F.lit("")) != "", F.col("participant_id"))
    return quotes.rollup("topic", "opinion").agg(F.count("*").alias("quotes"), F.countDistinct(said).alias("participants"), F.countDistinct("opinion").alias("opinions"))


def opinions_in_order(quotes: DataFrame) -> DataFrame:
    """Opinions of a topic by their number, ``Other`` last."""
    counts = quotes.groupBy("topic", "opinion").agg(F.count("*").alias("n"), F.min("ord").alias("o"))
    w = Window.partitionBy("topic").orderBy(F.col("opinion") == "Other", F.desc("n"), "o")
    return counts.select("topic", "opinion", "n", F.row_number().over(w).cast("bigint").alias("place"))


def demographics(long: DataFrame, most: int = 6, top: int = 5) -> DataFrame:
    """Histogram of each label's values; with over ``most`` values the ``top`` ones and ``Other``."""
    counts = long.groupBy("label", "value").agg(F.count("*").alias("n"))
    w = Window.partitionBy("label")
    ranked = counts.withColumn("_r", F.row_number().over(w.orderBy(F.desc("n"), "value"))).withColumn("_k", F.count("*").over(w))
    shown = F.when((F.col("_k") > most) & (F.col("_r") > top), "Other").otherwise(F.col("value"))
    return ranked.groupBy("label", shown.alias("value")).agg(F.sum("n").alias("n"))


def percent_and_offset(counts: DataFrame) -> DataFrame:
    """Whole percents of a label's total, and the sum of those before, values in order, ``Other`` last."""
    total = F.sum("n").over(Window.partitionBy("label"))
    before = Window.partitionBy("label").orderBy(F.col("value") == "Other", "value").rowsBetween(Window.unboundedPreceding, -1)
    with_percent = counts.withColumn("percent", F.round(100 * F.col("n") / total).cast("bigint"))
    return with_percent.withColumn("offset", F.coalesce(F.sum("percent").over(before), F.lit(0)).cast("bigint"))


def compare_groups(quotes: DataFrame, groups: Mapping[str, Sequence[tuple[str, str]]]) -> DataFrame:
    """Counts of each opinion within groups given by column values (A24): quotes, and participants; empty ones drop out.

    The groups are a handful of conditions, so a row goes to the groups it meets by an array, not by a join.
    """
    meets = []
    for name, conditions in groups.items():
        good = F.lit(True)
        for column, value in conditions:
            good = good & F.col(column).eqNullSafe(value)
        meets.append(F.when(good, F.lit(name)))
    each = quotes.withColumn("group", F.explode(F.filter(F.array(*meets), lambda x: x.isNotNull())))
    return each.groupBy("group", "topic", "opinion").agg(F.count("*").alias("quotes"), F.countDistinct("participant_id").alias("participants"))


def top_opinions(compared: DataFrame, first: str, k: int) -> DataFrame:
    """The first group's ``k`` largest opinions, with every group's counts."""
    top = compared.where(F.col("group") == first).orderBy(F.desc("quotes"), "topic", "opinion").limit(k).select("topic", "opinion")
    return compared.join(F.broadcast(top), ["topic", "opinion"], "left_semi")


def sample_quotes(quotes: DataFrame, score: Column, k: int = 4) -> DataFrame:
    """The ``k`` quotes of each opinion with the highest score."""
    w = Window.partitionBy("topic", "opinion").orderBy(F.desc_nulls_last("_s"), "ord")
    return quotes.withColumn("_s", score).withColumn("place", F.row_number().over(w).cast("bigint")).where(F.col("place") <= k).drop("_s")


def spread(rows: list[dict], k: int, seen: set) -> list[dict]:
    """Sample of a topic's quotes (G19): ``k`` rounds, in each of which every opinion gives its best quote by ``score``.

    Taken is the first of someone unseen anywhere, else of someone unseen in this topic, else any quote not yet taken.
    Opinions are in order of their number of quotes, ``Other`` last (O03).
    """
    by_opinion: dict[str, list[dict]] = {}
    for r in sorted(rows, key=lambda r: (r["place"], -r["score"], r["ord"])):
        by_opinion.setdefault(r["opinion"], []).append(r)
    taken: list[dict] = []
    here: set = set()
    for _ in range(k):
        for own in by_opinion.values():
            pick = next((r for r in own if r["participant_id"] not in seen and r["participant_id"] not in here), None)
            pick = pick or next((r for r in own if r["participant_id"] not in here), None) or next((r for r in own if r not in taken), None)
            if pick:
                taken.append(pick)
                seen.add(pick["participant_id"])
                here.add(pick["participant_id"])
    return taken


def topic_samples(quotes: DataFrame, k: int = 4, score: Column | None = None) -> DataFrame:
    """Samples of all topics by bridging score (G19): opinions times ``k`` quotes a topic, those with more people first (O04);
    who was seen goes from one topic to the next.

    It is one sequence of picks by nature, so what goes in is bounded without a change of the picks.  Of an opinion's quotes
    in order of their score only the ``need`` first ones of people in turn (their best quote each) can be a first or second
    choice, ``need`` being one more than the picks of all topics, since no more people than that can have been seen; any other
    quote is a third choice only where an opinion has fewer people than that, or among its ``need`` first quotes.
    """
    scored = quotes.withColumn("score", F.coalesce(score if score is not None else F.lit(0.0), F.lit(float("-inf"))))
    opinions = opinions_in_order(quotes).select("topic", "opinion", "place")
    need = k * opinions.count() + 1
    own = Window.partitionBy("topic", "opinion").orderBy(F.desc("score"), "ord")
    best = first_per(scored, ["topic", "opinion", "participant_id"], [F.desc("score"), F.col("ord")]).withColumn("_n", F.row_number().over(own)).where(F.col("_n") <= need).drop("_n")
    first = scored.withColumn("_n", F.row_number().over(own)).where(F.col("_n") <= need).drop("_n")
    columns = ["topic", "opinion", "participant_id", "quote", "ord", "score"]
    chosen = best.select(*columns).union(first.select(*columns)).distinct()
    people = quotes.where(F.trim("quote") != "").groupBy("topic").agg(F.countDistinct("participant_id").alias("_size"))
    sized = chosen.join(opinions, ["topic", "opinion"]).join(people, "topic", "left")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        seen: set = set()
        out: list[dict] = []
        for _, topic in sorted(pdf.groupby("topic"), key=lambda x: (-x[1]["_size"].fillna(0).iloc[0], x[0])):
            out += [r | {"place": i} for i, r in enumerate(spread(topic.to_dict("records"), k, seen), 1)]
        return pd.DataFrame(out, columns=["topic", "opinion", "participant_id", "quote", "place"])

    return sized.withColumn("_all", F.lit(0)).groupBy("_all").applyInPandas(run, "topic string, opinion string, participant_id bigint, quote string, place bigint")


def hierarchy(quotes: DataFrame, k: int | None = None) -> DataFrame:
    """Topics with opinions with quotes, each in order (R21, R22); at most ``k`` quotes an opinion, if given."""
    place = F.row_number().over(Window.partitionBy("topic", "opinion").orderBy("ord"))
    placed = quotes.withColumn("_p", place)
    placed = placed.where(F.col("_p") <= k) if k else placed
    opinions = placed.groupBy("topic", "opinion").agg(ordered_list("quote", "ord").alias("quotes"), F.count("*").alias("n"), F.min("ord").alias("o"))
    one = F.struct((F.col("opinion") == "Other").alias("last"), (-F.col("n")).alias("n"), "o", "opinion", "quotes")
    return opinions.groupBy("topic").agg(F.transform(F.array_sort(F.collect_list(one)), lambda x: F.struct(x["opinion"].alias("opinion"), x["quotes"].alias("quotes"))).alias("opinions"), F.sum("n").alias("n"))


def flat(tree: DataFrame) -> DataFrame:
    """A hierarchy as (topic, opinion, quote) rows."""
    rows = tree.select("topic", F.explode("opinions").alias("o"))
    return rows.select("topic", F.col("o.opinion").alias("opinion"), F.explode("o.quotes").alias("quote"))


def report_json(tree: DataFrame, overview: str, with_opinions: bool = True) -> DataFrame:
    """The report as one JSON document."""
    topic = F.struct("topic", "n", *(["opinions"] if with_opinions else []))
    return tree.agg(F.to_json(F.struct(F.lit(overview).alias("overview"), ordered_list(topic, -F.col("n"), "topic").alias("topics"))).alias("json"))


def with_summaries(topics: DataFrame, summaries: DataFrame) -> DataFrame:
    """Topics with the summary whose stripped title is theirs, the first one."""
    named = summaries.select(T.without_header(F.col("title")).alias("topic"), "summary", "ord")
    return topics.join(named.groupBy("topic").agg(F.min_by("summary", "ord").alias("summary")), "topic", "left")


def single_summary(rows: DataFrame, summaries: DataFrame) -> DataFrame:
    """Each (topic, opinion) with its one summary; none or several raise."""
    counted = summaries.groupBy("topic", "opinion").agg(F.count("*").alias("_n"), F.min("summary").alias("summary"))
    joined = rows.join(counted, ["topic", "opinion"], "left")
    wrong = F.raise_error(F.concat(F.lit("not one summary of "), F.col("topic"), F.lit(" / "), F.col("opinion"))).cast("string")
    return joined.withColumn("summary", F.when(F.coalesce(F.col("_n") == 1, F.lit(False)), F.col("summary")).otherwise(wrong)).drop("_n")


def predicted_agreement(raw: DataFrame) -> DataFrame:
    """Predicted agreement of groups, nested by statement."""
    return raw.groupBy("statement").agg(ordered_list(F.struct("group", "agree_rate"), "group").alias("groups"))


def excluded(quotes: DataFrame, topics: Sequence[str] = (), opinions: Sequence[str] = ()) -> DataFrame:
    """Without the topics and opinions that a report leaves out."""
    return quotes.where(~F.coalesce(F.col("topic").isin(list(topics)), F.lit(False)) & ~F.coalesce(F.col("opinion").isin(list(opinions)), F.lit(False)))
