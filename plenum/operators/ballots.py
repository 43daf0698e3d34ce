"""Wide second rounds as long tables: gallery answers, ranked sets, ballots."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .basics import first_per


def set_numbers(columns: Sequence[str]) -> list[int]:
    """Numbers of the ranked sets, in order."""
    return sorted({int(m[1]) for c in columns if (m := re.match(r"ranking_(\d+)_", c))})


def is_processed(columns: Sequence[str]) -> bool:
    """Whether ranked sets name their topic in the texts instead of a column."""
    return not any(re.fullmatch(r"ranking_\d+_topic", c) for c in columns)


def gallery(df: DataFrame, key: str = "participant_id") -> DataFrame:
    """(participant, n, topic, opinion, question, answer), where there is an answer."""
    numbers = sorted({int(m[1]) for c in df.columns if (m := re.fullmatch(r"question_(\d+)", c)) and f"answer_{m[1]}" in df.columns})
    have = lambda c: F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string")
    rows = [
        F.struct(F.lit(n).alias("n"), have(f"question_{n}_topic").alias("topic"), have(f"question_{n}_opinion").alias("opinion"), have(f"question_{n}").alias("question"), have(f"answer_{n}").alias("answer"))
        for n in numbers
    ]
    if not rows:
        return df.sparkSession.createDataFrame([], f"{key} string, n int, topic string, opinion string, question string, answer string")
    return df.select(key, F.explode(F.array(*rows)).alias("r")).select(key, "r.*").where("answer IS NOT NULL AND trim(answer) <> ''")


def ranked_items(df: DataFrame, key: str = "participant_id") -> DataFrame:
    """(participant, set_no, item_no, topic, statement, answer, rank) of all ranked sets, whichever way topics are given.

    ``rank`` is null where the answer is no number: a follow-up, not a ranked item.
    """
    processed, rows = is_processed(df.columns), []
    for c in df.columns:
        m = re.fullmatch(r"ranking_(\d+)_q_(\w+)", c)
        answer = c.replace("_q_", "_a_")
        if not m or answer not in df.columns:
            continue
        question = F.col(c).cast("string")
        topic = T.ranking_topic(question) if processed else F.col(f"ranking_{m[1]}_topic").cast("string")
        statement = T.without_ranking_topic(question) if processed else question
        rows.append(F.struct(F.lit(int(m[1])).alias("set_no"), F.lit(c).alias("item"), F.lit(len(rows)).alias("place"), topic.alias("topic"), statement.alias("statement"), F.col(answer).cast("string").alias("answer")))
    if not rows:
        return df.sparkSession.createDataFrame([], f"{key} string, set_no int, item string, place int, topic string, statement string, answer string, rank double")
    long = df.select(key, F.explode(F.array(*rows)).alias("r")).select(key, "r.*").where("statement IS NOT NULL AND answer IS NOT NULL AND trim(answer) <> ''")
    return long.withColumn("rank", T.to_number(F.col("answer")))


def ballots(df: DataFrame, key: str = "participant_id", least: int = 1) -> DataFrame:
    """(participant, topic, ranking): ranked items of a set in the order of their ranks, equal ones as the columns stand.

    Topics with fewer than ``least`` ballots are left out (R07).
    """
    ranked = ranked_items(df, key).where("rank IS NOT NULL AND NOT isnan(rank)")
    order = F.array_sort(F.collect_list(F.struct("rank", "place", "statement")))
    out = ranked.groupBy(key, "set_no").agg(F.min_by("topic", "place").alias("topic"), F.transform(order, lambda x: x["statement"]).alias("ranking"))
    if least > 1:
        out = out.join(out.groupBy("topic").count().where(F.col("count") >= least).select("topic"), "topic", "left_semi")
    return out.select(key, "topic", "ranking")


def ballots_of_rows(df: DataFrame, key: str = "participant_id", order: str = "ord", least: int = 1) -> DataFrame:
    """Ballots of each participant's first row."""
    return ballots(first_per(df, [key], [order]), key, least)


def participant_record(df: DataFrame, key: str = "participant_id") -> DataFrame:
    """A participant's answers as one tagged text (R24): the first round, gallery pairs, then rankings in order."""
    pair = F.concat(F.lit("<question>"), F.coalesce("question", F.lit("")), F.lit("</question>\n<response>"), F.col("answer"), F.lit("</response>"))
    pairs = gallery(df, key).groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", pair.alias("t")))), lambda x: x["t"]), "\n").alias("gallery"))
    items = ranked_items(df, key)
    listed = items.where("rank IS NOT NULL").groupBy(key, "set_no").agg(F.min("topic").alias("topic"), F.array_sort(F.collect_list(F.struct("rank", "place", "statement"))).alias("s"))
    lines = F.array_join(F.transform("s", lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), x["statement"])), "\n")
    block = F.concat(F.lit("<ranking topic=\""), F.coalesce("topic", F.lit("")), F.lit("\">\n"), lines, F.lit("\n</ranking>"))
    rankings = listed.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("set_no", block.alias("t")))), lambda x: x["t"]), "\n").alias("rankings"))
    first = F.col("survey_text") if "survey_text" in df.columns else F.lit(None).cast("string")
    return df.select(key, first.alias("first_round")).join(pairs, key, "left").join(rankings, key, "left").select(key, F.concat_ws("\n\n", "first_round", "gallery", "rankings").alias("record"))


def votes_of_replies(replies: DataFrame, votes: str = "votes") -> DataFrame:
    """Long approvals out of maps of votes; of repeated batches the later one holds, errors are no votes."""
    each = replies.select("participant_id", "batch", F.explode(votes).alias("proposition", "approved")).where("proposition <> 'error'")
    return each.groupBy("participant_id", "proposition").agg(F.max_by("approved", "batch").alias("approved"))


def agreement_questions(df: DataFrame, key: str = "participant_id") -> DataFrame:
    """Questions on topics and opinions with their answers, for agreement scores."""
    return gallery(df, key).withColumn("about", F.coalesce("topic", "opinion")).where("about IS NOT NULL")


def written_back(df: DataFrame, scores: DataFrame, key: str = "participant_id") -> DataFrame:
    """Agreement by question number as columns ``answer_N_agrees``."""
    numbers = sorted({int(m[1]) for c in df.columns if (m := re.fullmatch(r"answer_(\d+)", c))})
    wide = scores.groupBy(key).pivot("n", numbers).agg(F.first("agrees"))
    return df.join(wide.select(key, *(F.col(str(n)).alias(f"answer_{n}_agrees") for n in numbers)), key, "left")


def agreement(score: Column) -> Column:
    """Over 3 agrees, under 2 disagrees, else undecided."""
    return F.when(score > 3, F.lit(True)).when(score < 2, F.lit(False))
