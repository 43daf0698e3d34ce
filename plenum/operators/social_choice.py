"""Social choice: pairwise counts, strongest paths, proportional approval slates, greedy representation.

Ballots are ``(group..., ranking)`` with candidates from most to least preferred; approvals are long,
``(participant_id, proposition, approved)`` with a boolean or a number.  Counting is distributed and pre-aggregated;
what a group's path closure works on is its candidates' matrix, and what the slate loops carry is the slate itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialised


def pairwise_counts(ballots: DataFrame, by: Sequence[str] = (), ranking: str = "ranking") -> DataFrame:
    """How many ballots put a winner above a loser.

    The pairs are made inside each ballot, so nothing is shuffled but partial sums: at most the square of the candidates.
    """
    r = F.col(ranking)
    rest = lambda i: F.slice(r, i + 2, F.greatest(F.size(r) - i - 1, F.lit(0)))
    pairs = F.flatten(F.transform(r, lambda w, i: F.transform(rest(i), lambda x: F.struct(w.alias("winner"), x.alias("loser")))))
    return ballots.select(*by, F.explode(pairs).alias("p")).groupBy(*by, F.col("p.winner").alias("winner"), F.col("p.loser").alias("loser")).agg(F.count("*").alias("n"))


def candidates(ballots: DataFrame, by: Sequence[str] = (), ranking: str = "ranking") -> DataFrame:
    """Sorted distinct candidates with their index from 0."""
    each = ballots.select(*by, F.explode(ranking).alias("candidate")).distinct()
    return each.withColumn("i", F.row_number().over(Window.partitionBy(*by).orderBy("candidate")) - 1)


def margins(ballots: DataFrame, by: Sequence[str] = (), ranking: str = "ranking") -> DataFrame:
    """Per group its candidates and the matrix of margins; zero on the diagonal and where no ballot compares."""
    by = list(by) or ["_all"]
    ballots = ballots.withColumn("_all", F.lit(0)) if by == ["_all"] else ballots
    names = candidates(ballots, by, ranking)
    counts = pairwise_counts(ballots, by, ranking)
    # Each pair of candidates once for either side, then summed: a grid of the pairs that some ballot compares.
    signed = counts.select(*by, F.col("winner").alias("a"), F.col("loser").alias("b"), "n").unionAll(counts.select(*by, F.col("loser"), F.col("winner"), -F.col("n")))
    margin = signed.groupBy(*by, "a", "b").agg(F.sum("n").alias("m")).where("m <> 0")
    numbered = names.select(*by, F.col("candidate").alias("a"), F.col("i"))
    cells = margin.join(numbered, [*by, "a"]).join(numbered.select(*by, F.col("a").alias("b"), F.col("i").alias("j")), [*by, "b"])
    rows = cells.groupBy(*by, "i").agg(F.map_from_entries(F.collect_list(F.struct("j", "m"))).alias("row"))
    matrix = rows.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("i", "row"))).alias("cells"))
    listed = names.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "candidate"))), lambda x: x["candidate"]).alias("candidates"))
    at = F.sequence(F.lit(0), F.size("candidates") - 1)
    cell = lambda i, j: F.coalesce(F.try_element_at(F.try_element_at(F.col("cells"), i), j), F.lit(0).cast("bigint"))
    return listed.join(matrix, by, "left").select(*by, "candidates", F.transform(at, lambda i: F.transform(at, lambda j: cell(i, j))).alias("margins"))


def closure(matrix: Column) -> Column:
    """Strongest paths (G02): the best over all ways of their weakest step; losers keep their negative strength."""

    def through(p: Column, k: Column) -> Column:
        cell = lambda i, j: F.get(F.get(p, i), j)
        better = lambda r, i: F.transform(r, lambda x, j: F.when((i == j) | (i == k) | (j == k), x).otherwise(F.greatest(x, F.least(cell(i, k), cell(k, j)))))
        return F.transform(p, better)

    return F.aggregate(F.sequence(F.lit(0), F.size(matrix) - 1), matrix, through)


def strongest_paths(ballots: DataFrame, by: Sequence[str] = (), ranking: str = "ranking") -> DataFrame:
    return margins(ballots, by, ranking).withColumn("paths", closure(F.col("margins")))


def schulze(ballots: DataFrame, by: Sequence[str] = (), ranking: str = "ranking", k: int | None = None) -> DataFrame:
    """Schulze ranking (G03, G04): candidate, wins, losses, rank; ties in wins go to the greater candidate.

    ``strength`` is the path to the next in rank (G05, W06), null for the last.
    """
    own = list(by) or ["_all"]
    paths = strongest_paths(ballots, by, ranking)
    p, n = F.col("paths"), F.size("candidates")
    cell = lambda i, j: F.get(F.get(p, i), j)
    beats = lambda i: F.size(F.filter(F.sequence(F.lit(0), n - 1), lambda j: (i != j) & (cell(i, j) > cell(j, i))))
    beaten = lambda i: F.size(F.filter(F.sequence(F.lit(0), n - 1), lambda j: (i != j) & (cell(i, j) < cell(j, i))))
    each = F.transform("candidates", lambda c, i: F.struct(c.alias("candidate"), i.alias("i"), beats(i).alias("wins"), beaten(i).alias("losses")))
    w = Window.partitionBy(*own).orderBy(F.desc("e.wins"), F.desc("e.candidate"))
    rows = paths.select(*own, "paths", F.explode(each).alias("e")).withColumn("rank", F.row_number().over(w)).withColumn("next", F.lead("e.i").over(w))
    out = rows.select(*by, F.col("e.candidate").alias("candidate"), F.col("e.wins").cast("bigint").alias("wins"), F.col("e.losses").cast("bigint").alias("losses"), F.col("rank").cast("bigint").alias("rank"),
        F.get(F.get("paths", F.col("e.i")), F.col("next")).cast("bigint").alias("strength"))
    return out.where(F.col("rank") <= k) if k else out


# --- approvals ---------------------------------------------------------------------------------------------------------


def approval_means(votes: DataFrame, vote: str = "approved") -> DataFrame:
    """Votes of a participant for a proposition averaged (A07, G11); errors and missing votes are no rows."""
    return votes.where(F.col(vote).isNotNull()).groupBy("participant_id", "proposition").agg(F.avg(F.col(vote).cast("double")).alias("approved"))


def approval_rates(votes: DataFrame, vote: str = "approved") -> DataFrame:
    """Share of all voters, those without a vote for the proposition included as disapproving."""
    means = approval_means(votes, vote)
    voters = means.agg(F.countDistinct("participant_id")).first()[0]
    return means.groupBy("proposition").agg((F.sum("approved") / F.lit(max(1, voters))).alias("approval_rate"))


def approval_matrix(votes: DataFrame, propositions: Sequence[str], vote: str = "approved") -> DataFrame:
    """Wide matrix for export (A07): one column a proposition, missing votes 0."""
    return approval_means(votes, vote).groupBy("participant_id").pivot("proposition", list(propositions)).agg(F.first("approved")).na.fill(0.0, list(propositions))


def _profiles(votes: DataFrame) -> DataFrame:
    """Voters with equal approvals as one row with their number: what the slate loops read."""
    means = approval_means(votes).where("approved > 0")
    of_voter = means.groupBy("participant_id").agg(F.array_sort(F.collect_list(F.struct("proposition", "approved"))).alias("profile"))
    return materialised(of_voter.groupBy("profile").agg(F.count("*").alias("voters")))


def _best(scores: DataFrame, order: dict[str, int]) -> tuple[str, float] | None:
    """The candidate with the highest score, the first of the order among equals."""
    spark = scores.sparkSession
    place = spark.createDataFrame(list(order.items()), "proposition string, place bigint")
    found = place.join(scores, "proposition", "left").select("proposition", "place", F.coalesce(F.round("score", 9), F.lit(0.0)).alias("score"))
    row = found.orderBy(F.desc("score"), "place").first()
    return None if row is None else (row["proposition"], row["score"])


def pav_scores(profiles: DataFrame, slate: Sequence[str]) -> DataFrame:
    """Marginal score of each proposition (G06): for each approver one over one plus what of the slate it approves."""
    depth = F.aggregate(F.filter("profile", lambda x: x["proposition"].isin(list(slate)) if slate else F.lit(False)), F.lit(0.0), lambda a, x: a + x["approved"])
    rows = profiles.select("voters", depth.alias("depth"), F.explode("profile").alias("p"))
    return rows.groupBy(F.col("p.proposition").alias("proposition")).agg(F.sum(F.col("voters") / (1 + F.col("depth"))).alias("score"))


def pav_slate(votes: DataFrame, propositions: Sequence[str], k: int, seed: Sequence[str] = ()) -> list[tuple[str, float]]:
    """Sequential proportional approval voting (G08): ``k`` propositions in order, with their score when taken.

    A round is one aggregation over the profiles and one row to the driver; ``seed`` is a slate to start from.
    Propositions nobody approves score 0 and still fill the slate in their order.
    """
    profiles, taken = _profiles(votes), [(p, 0.0) for p in seed][:k]
    while len(taken) < k:
        slate = [p for p, _ in taken]
        open_ = {p: i for i, p in enumerate(propositions) if p not in slate}
        best = _best(pav_scores(profiles, slate), open_) if open_ else None
        if best is None:
            break
        taken.append(best)
    return taken


def schulze_pav(ballots: DataFrame, votes: DataFrame, propositions: Sequence[str], k: int) -> list[tuple[str, float]]:
    """A slate that starts with the Schulze winner (G09); a winner that no vote names counts as without approval."""
    winner = schulze(ballots, k=1).first()
    return pav_slate(votes, propositions, k, [winner["candidate"]] if winner else [])


def greedy_representation(votes: DataFrame, propositions: Sequence[str], k: int = 3) -> list[tuple[str, int]]:
    """Propositions that each cover most of the voters not yet represented (G10, U03, U04), with how many those are.

    Once all voters with any approval are represented, all count again; ``Other`` is never chosen; ties go to the first.
    """
    profiles, chosen, since = _profiles(votes), [], []
    voters = profiles.agg(F.sum("voters")).first()[0] or 0
    while len(chosen) < k:
        open_ = {p: i for i, p in enumerate(propositions) if p != "Other" and p not in [c for c, _ in chosen]}
        if not open_ or not voters:
            break
        own = F.transform("profile", lambda x: x["proposition"])
        left = profiles.where(F.size(F.array_intersect(own, F.array(*map(F.lit, since)))) == 0) if since else profiles
        best = _best(left.select("voters", F.explode(own).alias("proposition")).groupBy("proposition").agg(F.sum("voters").cast("double").alias("score")), open_)
        if best[1] == 0 and since:
            since = []  # nobody new can be represented: start over with all voters
            continue
        chosen.append((best[0], int(best[1])))
        since.append(best[0])
        if left.where(~F.array_contains(own, best[0])).limit(1).count() == 0:
            since = []
    return chosen
