"""Groups of rows as tagged texts for prompts (M32, M33, M34, M43): ordered aggregation, our own wording."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codecs
from ..functions import text as T
from .basics import ordered_list


def element(name: str, c: Column) -> Column:
    return F.concat(F.lit(f"<{name}>"), F.coalesce(c.cast("string"), F.lit("")), F.lit(f"</{name}>"))


def first_round(quotes: DataFrame, use_quote: bool = True) -> DataFrame:
    """(topic, opinion, text): each participant's quote on an opinion, by participant."""
    said = T.clean_quote(F.col("quote" if use_quote else "survey_text"))
    one = F.concat(F.lit("<participant id=\""), F.col("participant_id").cast("string"), F.lit("\">"), said, F.lit("</participant>"))
    return quotes.groupBy("topic", "opinion").agg(F.array_join(ordered_list(one, "participant_id", "ord"), "\n").alias("text"))


def second_round(gallery: DataFrame, ranked: DataFrame) -> DataFrame:
    """(participant_id, text): gallery answers, then rankings by rank; items without a numeric rank come last."""
    answers = F.concat(element("question", F.col("question")), element("response", F.col("answer")))
    g = gallery.groupBy("participant_id").agg(F.array_join(ordered_list(answers, "n"), "\n").alias("g"))
    place = F.coalesce(F.nanvl("rank", F.lit(float("inf"))), F.lit(float("inf")))
    items = ranked.groupBy("participant_id", "set_no").agg(T.numbered(ordered_list("statement", place, "place")).alias("t"))
    r = items.groupBy("participant_id").agg(F.array_join(ordered_list(element("ranking", F.col("t")), "set_no"), "\n").alias("r"))
    return g.join(r, "participant_id", "full_outer").select("participant_id", F.concat_ws("\n", "g", "r").alias("text"))


def with_dictionary(df: DataFrame, column: str, by: str) -> DataFrame:
    """A group's repeated texts as keys after a list of them."""
    grouped = df.groupBy(by).agg(ordered_list(column, "ord").alias("texts"))
    keyed = grouped.withColumn("keys", codecs.reusable(F.col("texts")))
    listed = F.transform("keys", lambda k: F.concat(k["key"], F.lit(": "), k["text"]))
    shown = F.transform("texts", lambda t: F.coalesce(F.try_element_at(F.transform(F.filter(F.col("keys"), lambda k: k["text"] == t), lambda k: k["key"]), F.lit(1)), t))
    return keyed.select(by, F.array_join(listed, "\n").alias("dictionary"), F.array_join(shown, "\n").alias("text"))


def equivalence(propositions: DataFrame) -> DataFrame:
    """One prompt that asks for sets of propositions that say the same."""
    lines = ordered_list(F.concat("proposition_id", F.lit(": "), "proposition"), "proposition_id")
    ask = 'Which of these statements say the same? JSON {"equivalence_sets": [[ids]]}, sets of two or more.\n'
    return propositions.agg(F.concat(F.lit(ask), F.array_join(lines, "\n")).alias("prompt"))


def collision(group: list[dict]) -> str:
    """Which of several equivalent propositions to keep."""
    return "Keep one of these statements, answer with its id.\n" + "\n".join(f"{p['proposition_id']} ({p['topic']}): {p['proposition']}" for p in group)


def winning_topic(sets: DataFrame, propositions: DataFrame) -> DataFrame:
    """(set_id, prompt): which topic a set of equivalent propositions belongs to."""
    from .dedup import members

    rows = members(sets).join(propositions, "proposition_id")
    line = F.concat(F.col("topic"), F.lit(": "), F.col("proposition"))
    return rows.groupBy("set_id").agg(F.concat(F.lit("To which of the topics do these statements belong? Answer with the topic.\n"), F.array_join(ordered_list(line, "topic", "proposition_id"), "\n")).alias("prompt"))


def quote_criteria(topic_first: bool = True) -> str:
    """What a judge of extracted quotes looks at."""
    parts = ["the quote says what the answer says on the topic", "its words are the answer's, but for what stands in brackets", "nothing on other topics is left in"]
    return "; ".join(parts if topic_first else parts[1:] + parts[:1]) + "."
