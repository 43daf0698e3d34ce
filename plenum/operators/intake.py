"""Survey intake: finished rows, respondent ids, the texts of both rounds, moderation scores."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from itertools import zip_longest

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .basics import numbered_rows, row_max

DURATION = "Duration (in seconds)"
#: Families of columns of a first round; other surveys give their own.
ROUND_1 = {"questions": ("Q1", "Q2", "Q3"), "follow_ups": ("Q1FU_Text", "Q2FU_Text", "Q3FU_Text")}


def finished(df: DataFrame) -> DataFrame:
    """Finished rows that are no previews."""
    return df.where(F.lower(F.col("Finished").cast("string")).isin("true", "1") & ~F.col("Status").eqNullSafe("Survey Preview"))


def with_respondent_ids(df: DataFrame, first: str = "rid", second: str = "rdud", name: str = "participant_id") -> DataFrame:
    """Ids from the first or the second column; if any row has neither, or a blank one, all rows are numbered."""
    own = [F.col(c).cast("string") for c in (first, second) if c in df.columns]
    if not own:
        return numbered_rows(df, name).withColumn(name, F.col(name).cast("string"))
    given = F.coalesce(*own)
    missing = df.select(F.bool_or(F.coalesce(F.trim(given) == "", F.lit(True)))).first()[0]
    if missing:
        return numbered_rows(df, name).withColumn(name, F.col(name).cast("string")).drop(first, second)
    return df.withColumn(name, given).drop(first, second)


def renamed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """P03, P04"""
    return df.withColumnsRenamed(dict(names))


def first_missing(df: DataFrame, required: Sequence[str]) -> str | None:
    """The first required column that is not there, whatever the case."""
    have = {c.lower() for c in df.columns}
    return next((c for c in required if c.lower() not in have), None)


def round_1_required() -> list[str]:
    return ["participant_id", "topic", "opinion", "quote"]


def round_2_required() -> list[str]:
    return ["participant_id", *(f"{a}_{n}{b}" for n in range(2, 7) for a, b in (("question", ""), ("question", "_topic"), ("question", "_opinion"), ("answer", "")))]


def required_fields(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows as they are, or an error that names the row of a blank field."""
    for c in columns:
        wrong = F.coalesce(F.trim(F.col(c)) == "", F.lit(True))
        df = df.withColumn(c, F.when(wrong, F.raise_error(F.concat(F.lit(f"{c} is missing in row "), F.col("ord").cast("string"))).cast("string")).otherwise(F.col(c)))
    return df


def interleaved(a: Sequence[str], b: Sequence[str]) -> list[str]:
    """Questions and their follow-ups in turn."""
    return [x for pair in zip_longest(a, b) for x in pair if x is not None]


def _answer(name: str, nan: bool) -> Column:
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("nan" if nan else ""))


def round_1_texts(df: DataFrame, questions: Mapping[str, str], columns: Sequence[str], one_line: bool = True, nan: bool = False) -> DataFrame:
    """``survey_text`` (tagged pairs) and ``response_text`` (numbered answers) of a first round.

    A missing answer is empty; with ``nan`` it reads ``nan``, as older files have it (N10).
    """
    texts = [(questions.get(c, c).split("\n")[0] if one_line else questions.get(c, c), _answer(c, nan)) for c in columns]
    pair = lambda q, a: F.concat(F.lit(f"<question>{q}</question>\n<response>"), a, F.lit("</response>"))
    return df.withColumns({
        "survey_text": F.concat_ws("\n\n", *(pair(q, a) for q, a in texts)),
        "response_text": F.concat_ws("\n\n", *(F.concat(F.lit(f"Response {i}: "), a) for i, (_, a) in enumerate(texts, 1))),
    })


def labelled_responses(groups: Mapping[str, Sequence[str]]) -> Column:
    """``label:\\nanswer`` for each text answer of the groups; numbers and blanks are left out."""
    parts = [F.when(T.is_text_response(F.col(c)), F.concat(F.lit(f"{label}:\n"), F.col(c))) for label, columns in groups.items() for c in columns]
    return F.concat_ws("\n\n", *parts)


def round_2_columns(df: DataFrame, questions: Mapping[str, str], gallery: Sequence[str], rankings: Sequence[str], comments: Sequence[str]) -> DataFrame:
    """Answers under their own names beside constant question texts, topics, opinions and quotes."""
    spark, new = df.sparkSession, {}
    texts = spark.createDataFrame([(c, questions.get(c, "")) for c in gallery] or [("", "")], "c string, t string")
    parts = {r["c"]: r["p"] for r in texts.select("c", T.topic_opinion_quote(F.col("t")).alias("p")).collect()}
    new["response_text"] = labelled_responses({"GOV Response": gallery, "Ranking Response": comments})
    for c in gallery:
        n = c.rpartition("_")[2]
        p = parts[c]
        new |= {f"answer_{n}": F.col(c), f"question_{n}": F.lit(p["quote"] or questions.get(c, "")), f"question_{n}_topic": F.lit(p["topic"]), f"question_{n}_opinion": F.lit(p["opinion"])}
    for c in rankings:
        base = c.replace("_q_", "_a_")
        new |= {base: F.floor(T.to_number(F.col(c))).cast("int"), c: F.lit(questions.get(c, ""))}
    for c in comments:
        new |= {c.replace("_q_", "_a_"): F.col(c), c: F.lit(questions.get(c, ""))}
    source = df.withColumnsRenamed({})
    return source.select(*(c for c in source.columns if c not in new), *(v.alias(k) for k, v in new.items()))


def typed_intro(df: DataFrame) -> DataFrame:
    """The first round's text, and the intro question where both its parts are there."""
    both = F.col("question_1").isNotNull() & F.col("answer_1").isNotNull()
    return df.withColumn("intro", F.when(both, F.struct(F.col("question_1").alias("question"), F.col("answer_1").alias("answer"))))


def sheet_join(r1: DataFrame, r2: DataFrame, key: str = "participant_id") -> DataFrame:
    """Both rounds of each participant."""
    from .basics import full_outer

    return full_outer(r1, r2, key, ("_r1", "_r2"))


def reconstituted_pool(by_opinion: DataFrame) -> DataFrame:
    """Participants out of the nested rounds of all opinions, each once, with where they were found."""
    from .basics import first_per, full_outer

    def people(column: str) -> DataFrame:
        """The first row of each participant, opinions in order of their names, then rows as they stand."""
        keys = [c for c in ("topic", "opinion") if c in by_opinion.columns]
        rows = by_opinion.select(F.struct(*keys).alias("_k") if keys else F.lit(0).alias("_k"), F.posexplode(column).alias("_p", "p"))
        return first_per(rows.select("_k", "_p", "p.*"), ["participant_id"], ["_k", "_p"]).drop("_k", "_p")

    return full_outer(people("r1_df"), people("r2_df"), "participant_id", ("_r1", "_r2"), "_merge")


def round_overlap(r1: DataFrame, r2: DataFrame) -> DataFrame:
    """Participants of each round and of both."""
    a, b = (d.select("participant_id").distinct() for d in (r1, r2))
    sides = a.withColumn("x", F.lit(1)).unionAll(b.withColumn("x", F.lit(2))).groupBy("participant_id").agg(F.sum("x").alias("x"))
    return sides.agg(F.count_if(F.col("x") != 2).alias("in_r1"), F.count_if(F.col("x") >= 2).alias("in_r2"), F.count_if(F.col("x") == 3).alias("in_both"))


# --- moderation ---------------------------------------------------------------------------------------------------------


def too_fast(df: DataFrame, duration: str, name: str = "too_fast") -> DataFrame:
    """How far a duration is below the 0.9 quantile, from 0 to 1 (A18, F13); the quantile is one number."""
    q = df.select(F.expr(f"percentile(`{duration}`, 0.9)")).first()[0]
    share = 1 - F.try_divide(F.col(f"`{duration}`").cast("double"), F.lit(q).cast("double"))
    return df.withColumn(name, F.greatest(F.lit(0.0), F.least(F.lit(1.0), share)))


def spamminess(df: DataFrame, score: str, name: str = "spam") -> DataFrame:
    """One minus the score over the highest one."""
    high = df.agg(F.max(score)).first()[0]
    return df.withColumn(name, 1 - F.try_divide(F.col(score).cast("double"), F.lit(high).cast("double")))


def snippet_maxima(df: DataFrame, snippets: Column, scorers: Mapping[str, Column], key: str = "row_id") -> DataFrame:
    """Each attribute's highest score over a row's snippets (A15, M21).  ``scorers`` are expressions over ``snippet``."""
    rows = df.select(key, F.explode(snippets).alias("snippet")).select(key, *(c.alias(n) for n, c in scorers.items()))
    return df.join(rows.groupBy(key).agg(*(F.max(n).alias(n) for n in scorers)), key, "left")


def findings(df: DataFrame, patterns: Mapping[str, str], key: str = "row_id", text: str = "text", most: int = 3) -> DataFrame:
    """Distinct findings of each kind of personal data, one a line (A31, M22 offline): at most ``most`` of each."""
    found = lambda p: F.array_join(F.slice(F.array_sort(F.array_distinct(F.regexp_extract_all(F.col(text), F.lit(p), F.lit(0)))), 1, most), "\n")
    return df.select(key, *(found(p).alias(n) for n, p in patterns.items()))


#: Patterns of personal data; a service would know more kinds.
PERSONAL = {
    "EMAIL_ADDRESS": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "IP_ADDRESS": r"\b(?:\d{1,3}\.){3}\d{1,3}\b",
    "CREDIT_CARD_NUMBER": r"\b\d{4}[ -]?\d{4}[ -]?\d{4}[ -]?\d{4}\b",
    "US_SOCIAL_SECURITY_NUMBER": r"\b\d{3}-\d{2}-\d{4}\b",
    "PHONE_NUMBER": r"(?:\+\d{1,3}[ -])?\(?\d{3}\)?[ -]\d{3}[ -]\d{4}\b",
}


def moderation_order(df: DataFrame, scores: Sequence[str]) -> DataFrame:
    """Rows by their highest score, those without any last."""
    return df.withColumn("max_score", row_max(scores)).orderBy(F.desc_nulls_last("max_score"), "ord")


def demo_columns(df: DataFrame, prefix: str = "demo:") -> list[str]:
    return [c for c in df.columns if re.match(re.escape(prefix), c)]


def unpivoted_demographics(df: DataFrame, columns: Sequence[str] | None = None, key: str = "participant_id") -> DataFrame:
    """(participant, label, value) of all demographic columns; blanks are no values."""
    columns = list(columns or demo_columns(df))
    pairs = F.array(*(F.struct(F.lit(c.removeprefix("demo:")).alias("label"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns))
    return df.select(key, F.explode(pairs).alias("p")).select(key, "p.label", "p.value").where("trim(value) <> ''")


def first_rows(df: DataFrame, key: str = "participant_id", order: str = "ord") -> DataFrame:
    w = Window.partitionBy(key).orderBy(order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
