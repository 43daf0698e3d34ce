"""From propositions to a ranked selection: the nine stages of a refinement, each a table of the run.

``propositions``: topic, opinion, idx, proposition; ``people``: participant_id, record; votes and ballots are long tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import dedup, pipelines, prompts, social_choice
from .basics import ordered_list, top_per
from .inference import Inference
from .lifecycle import Run


def by_opinion(r1: DataFrame, r2: DataFrame, allocated: int = 5) -> DataFrame:
    """Each (topic, opinion) with both rounds' rows as nested arrays and their numbers, topics descending."""
    a = r1.groupBy("topic", "opinion").agg(F.count("*").alias("r1_length"), ordered_list(F.struct("participant_id", "quote"), "participant_id", "ord").alias("r1"))
    b = r2.groupBy("opinion").agg(F.count("*").alias("r2_length"), ordered_list(F.struct("participant_id", "question", "answer"), "participant_id", "n").alias("r2"))
    joined = a.join(b, "opinion", "left").withColumn("r2_length", F.coalesce("r2_length", F.lit(0))).withColumn("allocations", F.lit(allocated))
    return joined.select("topic", "opinion", "r1_length", "r2_length", "allocations", "r1", "r2").orderBy(F.desc("topic"), "opinion")


def exploded(opinions: DataFrame) -> DataFrame:
    """Nested propositions as rows."""
    return opinions.select("topic", "opinion", F.posexplode("propositions").alias("idx", "proposition"))


def enriched_topics(opinions: DataFrame, rates: DataFrame) -> DataFrame:
    """Per topic its propositions with approval rates, and the first-round rows of its opinions."""
    rows = exploded(opinions).join(rates, "proposition", "left")
    nested = rows.groupBy("topic").agg(ordered_list(F.struct("opinion", "proposition", F.coalesce("approval_rate", F.lit(0.0)).alias("approval_rate")), "opinion", "idx").alias("propositions"))
    return nested.join(opinions.groupBy("topic").agg(F.sum("r1_length").alias("r1_quotes_by_topic")), "topic")


def with_rates(statements: DataFrame, votes: DataFrame) -> DataFrame:
    """Statements with their agree rate, an earlier one replaced."""
    rates = social_choice.approval_rates(votes).select(F.col("proposition").alias("statement"), F.col("approval_rate").alias("agree_rate"))
    return statements.drop("agree_rate").join(rates, "statement", "left")


def with_scores(rows: DataFrame, scores: DataFrame, key: str = "row_id") -> DataFrame:
    """Rows with scores by their id."""
    return rows.join(scores, key, "left")


def skipped_rows(rows: DataFrame, skipped: DataFrame, key: str = "participant_id") -> DataFrame:
    """Rows of the statements that were skipped."""
    return rows.join(skipped.select(key).distinct(), key, "left_semi")


def ranked(ballots: DataFrame, by: list[str], votes: DataFrame | None = None, k: int | None = None) -> DataFrame:
    """(by..., proposition, rank, method): Schulze, or with votes a slate of PAV after each group's candidates."""
    order = social_choice.schulze(ballots, by, k=k).select(*by, F.col("candidate").alias("proposition"), "rank")
    if votes is None:
        return order.withColumn("method", F.lit("schulze"))
    spark, rows = ballots.sparkSession, []
    groups = order.groupBy(*by).agg(ordered_list("proposition", "rank").alias("p")) if by else order.agg(ordered_list("proposition", "rank").alias("p"))
    for g in groups.toLocalIterator():  # groups are topics or opinions; a slate is a few rounds each
        own = votes.where(F.col("proposition").isin(g["p"]))
        rows += [(*(g[c] for c in by), p, i) for i, (p, _) in enumerate(social_choice.pav_slate(own, g["p"], k or len(g["p"])), 1)]
    schema = ", ".join([*(f"{c} string" for c in by), "proposition string", "rank bigint"])
    return spark.createDataFrame(rows, schema).withColumn("method", F.lit("pav"))


def equivalence_sets(infer: Inference, propositions: DataFrame) -> DataFrame:
    """Sets of known ids with two members or more, by the model."""
    sets = infer(prompts.equivalence(propositions), "equivalence", "equivalence_sets ARRAY<ARRAY<STRING>>").select(F.posexplode("parsed.equivalence_sets").alias("n", "m"))
    known = sets.select("n", F.explode(F.array_distinct("m")).alias("proposition_id")).join(propositions.select("proposition_id"), "proposition_id", "left_semi")
    return known.groupBy("n").agg(F.array_sort(F.collect_list("proposition_id")).alias("members")).where("size(members) >= 2").select(F.col("n").cast("string").alias("set_id"), "members")


def model_judge(ask: Callable[[str], str]) -> Callable[[list[dict]], str]:
    """A judge for the draft (G15): the first id in the reply that is one of the group, else the best rank."""
    import re

    def judge(group: list[dict]) -> str:
        named = re.findall(r"\d+:\d+", ask(prompts.collision(group)))
        ids = {p["proposition_id"] for p in group}
        return next((n for n in named if n in ids), dedup.lowest_rank(group))

    return judge


def judged_topics(infer: Inference, sets: DataFrame, propositions: DataFrame) -> DataFrame:
    """(set_id, winner) by the model (G18); a reply that names none of the set's topics keeps the best rank's topic."""
    replies = infer(prompts.winning_topic(sets, propositions), "winning topic").select("set_id", F.trim("response").alias("reply"))
    rows = dedup.members(sets).join(propositions, "proposition_id").join(replies, "set_id", "left")
    named = F.max(F.when(F.contains("reply", F.col("topic")), F.col("topic")))
    return rows.groupBy("set_id").agg(F.coalesce(named, F.min_by("topic", F.struct("rank", "topic"))).alias("winner"))


def refine(run: Run, infer: Inference, opinions: DataFrame, people: DataFrame, real_ballots: DataFrame | None = None, k: int = 3, top: int = 10, pav: bool = True, method: str = "rank_filling") -> DataFrame:
    """All stages; what an earlier run has finished is read, not made again.

    1 ranking of the real ballots, 2 approval jury over all propositions, 3 ranking within opinions, 4 ranking within
    topics, 5 de-duplication, 6 combinations, 7 their approval, 8 their ranking, 9 the final choice.
    """
    if real_ballots is not None:
        run.stage("r2_opinion_ranking", lambda: social_choice.schulze(real_ballots, ["topic"]))
    rows = exploded(opinions)
    names = lambda df: sorted(r[0] for r in df.select("proposition").distinct().collect())  # noqa: E731  what jurors are asked, a list of statements
    votes = run.stage("approvals", lambda: pipelines.jury(infer, people, names(rows), batch=15))

    def rank_within(df: DataFrame, by: list[str]) -> DataFrame:
        out = None
        for g in df.select(*by).distinct().toLocalIterator():
            own = df
            for c in by:
                own = own.where(F.col(c) == g[c])
            statements = names(own)
            # A single proposition needs no jury.
            one = pipelines.jury(infer, people, statements, "RANK").select("ranking") if len(statements) > 1 else df.sparkSession.createDataFrame([(statements,)], "ranking array<string>")
            for c in by:
                one = one.withColumn(c, F.lit(g[c]))
            out = one if out is None else out.unionByName(one)
        return ranked(out, by, votes if pav else None)

    in_opinions = run.stage("opinion_rankings", lambda: rank_within(rows, ["topic", "opinion"]))
    best = top_per(in_opinions, ["topic", "opinion"], [F.col("rank")], k, "place")
    in_topics = run.stage("topic_rankings", lambda: rank_within(best, ["topic"]))
    quotes = opinions.groupBy("topic").agg(F.sum("r1_length").alias("r1_quotes"))
    listed = in_topics.join(quotes, "topic").select("topic", "r1_quotes", (F.col("rank") - 1).cast("int").alias("idx"), "proposition", "rank")
    ids = dedup.with_ids(listed)
    sets = run.stage("equivalence", lambda: equivalence_sets(infer, ids))
    pick = dedup.rank_filling if method == "rank_filling" else dedup.winning_topics
    chosen = run.stage("selected", lambda: pick(ids, sets, k).join(ids.select("proposition_id", F.col("rank").alias("_r")), "proposition_id").drop("rank").withColumnRenamed("_r", "rank"))
    nuanced = run.stage("nuanced", lambda: pipelines.nuanced_propositions(infer, chosen))
    nuanced_votes = run.stage("nuanced_approvals", lambda: pipelines.jury(infer, people, names(nuanced), batch=15))
    nuanced_ballots = run.stage("nuanced_ballots", lambda: pipelines.jury(infer, people, names(nuanced), "RANK"))
    return run.stage("top_nuanced", lambda: ranked(nuanced_ballots.select("ranking"), [], nuanced_votes if pav else None, top))


def learned_runs(infer: Inference, quotes: DataFrame, runs: int) -> DataFrame:
    """Opinion learning several times over (M40): (run, topic, opinion) of each."""
    out = None
    for n in range(runs):
        again = quotes.withColumn("text", F.concat("text", F.lit(" " * n)))  # another prompt, so another reply
        one = pipelines.learned_opinions(infer, again).withColumn("run", F.lit(n))
        out = one if out is None else out.unionByName(one)
    return out


def evaluated_rounds(infer: Inference, r2: DataFrame, propositions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Agreement of second-round answers, and topic and opinion scores of propositions."""
    from . import ballots, evals

    asked = ballots.agreement_questions(r2).withColumn("response", F.col("answer"))
    metric = evals.Metric("agreement", ("question",), "answer", "How far does the answer agree with the question's statement, from 0 to 4.")
    scored = pipelines.evaluated(infer, asked.select("participant_id", "n", "question", "response"), metric)
    agrees = ballots.written_back(r2, evals.agreement_of_scores(scored))
    rows = propositions.select("topic", "opinion", F.col("proposition").alias("response"))
    both = {m: pipelines.evaluated(infer, rows, evals.METRICS[m]).select("topic", "opinion", F.col("response").alias("proposition"), "score") for m in ("proposition_topic", "proposition_opinion")}
    return agrees, evals.proposition_scores(propositions, both["proposition_topic"], both["proposition_opinion"])
