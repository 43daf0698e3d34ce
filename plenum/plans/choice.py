"""Queries: votes, ballots, rankings, slates, named queries over them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ballots as B
from ..operators import dedup, social_choice, world
from .registry import VIEWS, pb, pb25, pv, pvs, pw, query

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@query("+n AS (SELECT count(DISTINCT participant_id) AS n FROM pm) SELECT proposition, round(sum(approved) / (SELECT n FROM n), 6) AS approval_rate FROM pm GROUP BY proposition", "pv", "pm")
def a06_approval_rates(spark, d):
    return social_choice.approval_rates(pv(spark, d)).withColumn("approval_rate", F.round("approval_rate", 6))


@query(
    """+m AS (SELECT participant_id, proposition, avg(CASE WHEN approved THEN 1.0 ELSE 0.0 END) AS a FROM pvs GROUP BY ALL)
SELECT proposition, round(sum(a) / (SELECT count(DISTINCT participant_id) FROM m), 6) AS approval_rate FROM m GROUP BY proposition""",
    "pvs",
)
def a06_sparse_approval_rates(spark, d):
    return social_choice.approval_rates(pvs(spark, d)).withColumn("approval_rate", F.round("approval_rate", 6))


@query(
    "SELECT participant_id, " + ", ".join(f"round(coalesce(max(approved) FILTER (proposition = '{p}'), 0), 6) AS {p}" for p in EVENT_TYPES) + " FROM pm GROUP BY participant_id", "pv", "pm"
)
def a07_approval_matrix(spark, d):
    return social_choice.approval_matrix(pv(spark, d), EVENT_TYPES).select("participant_id", *(F.round(p, 6).alias(p) for p in EVENT_TYPES))


@query("SELECT participant_id, proposition, round(approved, 6) AS approved FROM pm", "pv", "pm")
def g11_approval_means(spark, d):
    return social_choice.approval_means(pv(spark, d)).withColumn("approved", F.round("approved", 6))


@query(
    """+b AS (SELECT participant_id, proposition, event_id % 3 AS batch, arg_max(value > 20, event_id) AS approved FROM (SELECT user_id AS participant_id, event_type AS proposition, * FROM events) GROUP BY ALL)
SELECT participant_id, proposition, arg_max(approved, batch) AS approved FROM b WHERE proposition <> 'error' GROUP BY ALL"""
)
def a08_later_batch_holds(spark, d):
    from ..session import table

    e = table(spark, d, "events").groupBy(F.col("user_id").alias("participant_id"), (F.col("event_id") % 3).alias("batch"), "event_type").agg(F.max_by(F.col("value") > 20, "event_id").alias("v"))
    replies = e.groupBy("participant_id", "batch").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "v"))).alias("votes"))
    return B.votes_of_replies(replies)


PAIRS = "SELECT a.candidate AS winner, b.candidate AS loser, count(*) AS n FROM {v} a JOIN {v} b ON a.ballot = b.ballot AND a.pos < b.pos GROUP BY ALL"


@query(PAIRS.format(v="pb"), "pb")
def g01_pairwise_counts(spark, d):
    return social_choice.pairwise_counts(pb(spark, d))


@query(PAIRS.format(v="pb25"), "pb25")
def g01_pairwise_counts_25(spark, d):
    return social_choice.pairwise_counts(pb25(spark, d))


def _paths_sql(v: str) -> str:
    return f"""+pairs AS ({PAIRS.format(v=v)}), c AS (SELECT candidate, row_number() OVER (ORDER BY candidate) AS i FROM (SELECT DISTINCT candidate FROM {v})),
m AS (SELECT a.i AS i, b.i AS j, CAST(coalesce(x.n, 0) - coalesce(y.n, 0) AS BIGINT) AS p FROM c a CROSS JOIN c b
    LEFT JOIN pairs x ON x.winner = a.candidate AND x.loser = b.candidate LEFT JOIN pairs y ON y.winner = b.candidate AND y.loser = a.candidate),
walk(k, i, j, p) AS (SELECT 0, i, j, p FROM m UNION ALL
    SELECT w.k + 1, w.i, w.j, CASE WHEN w.i = w.j OR w.i = w.k + 1 OR w.j = w.k + 1 THEN w.p ELSE greatest(w.p, least(x.p, y.p)) END
    FROM walk w JOIN walk x ON x.i = w.i AND x.j = w.k + 1 JOIN walk y ON y.i = w.k + 1 AND y.j = w.j WHERE w.k < (SELECT count(*) FROM c)),
paths AS (SELECT i, j, p FROM walk WHERE k = (SELECT count(*) FROM c)),
wins AS (SELECT x.i, count(*) FILTER (x.p > y.p) AS wins, count(*) FILTER (x.p < y.p) AS losses FROM paths x JOIN paths y ON x.i = y.j AND x.j = y.i AND x.i <> x.j GROUP BY x.i),
ranked AS (SELECT candidate, i, wins, losses, row_number() OVER (ORDER BY wins DESC, candidate DESC) AS rank FROM wins JOIN c USING (i)),
nexts AS (SELECT *, lead(i) OVER (ORDER BY rank) AS nx FROM ranked)"""


def _schulze_sql(v: str) -> str:
    return _paths_sql(v) + " SELECT candidate, wins, losses, rank, p AS strength FROM nexts LEFT JOIN paths ON nexts.i = paths.i AND nexts.nx = paths.j"


@query(_schulze_sql("pb"), "pb", recursive=True)
def g04_schulze_ranking(spark, d):
    return social_choice.schulze(pb(spark, d))


@query(_schulze_sql("pb25"), "pb25", recursive=True)
def g04_schulze_ranking_25(spark, d):
    return social_choice.schulze(pb25(spark, d))


@query(_paths_sql("pb") + " SELECT a.candidate AS winner, b.candidate AS loser, p AS strength FROM paths JOIN c a ON a.i = paths.i JOIN c b ON b.i = paths.j", "pb", recursive=True)
def g02_strongest_paths(spark, d):
    rows = social_choice.strongest_paths(pb(spark, d)).select("candidates", F.posexplode("paths").alias("i", "row")).select("candidates", "i", F.posexplode("row").alias("j", "strength"))
    return rows.select(F.get("candidates", F.col("i")).alias("winner"), F.get("candidates", F.col("j")).alias("loser"), F.col("strength").cast("bigint").alias("strength"))


VIEWS["pbt"] = """pbt AS (SELECT c_mktsegment AS topic, o_custkey AS ballot, o_orderpriority AS candidate, row_number() OVER (PARTITION BY o_custkey ORDER BY count(*) DESC, o_orderpriority) AS pos
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment, o_custkey, o_orderpriority)"""


@query(
    """+pairs AS (SELECT a.topic, a.candidate AS winner, b.candidate AS loser, count(*) AS n FROM pbt a JOIN pbt b ON a.ballot = b.ballot AND a.pos < b.pos GROUP BY ALL),
c AS (SELECT topic, candidate, row_number() OVER (PARTITION BY topic ORDER BY candidate) AS i, count(*) OVER (PARTITION BY topic) AS k FROM (SELECT DISTINCT topic, candidate FROM pbt)),
m AS (SELECT a.topic, a.k AS size, a.i AS i, b.i AS j, CAST(coalesce(x.n, 0) - coalesce(y.n, 0) AS BIGINT) AS p FROM c a JOIN c b ON a.topic = b.topic
    LEFT JOIN pairs x ON x.topic = a.topic AND x.winner = a.candidate AND x.loser = b.candidate LEFT JOIN pairs y ON y.topic = a.topic AND y.winner = b.candidate AND y.loser = a.candidate),
walk(k, topic, size, i, j, p) AS (SELECT 0, topic, size, i, j, p FROM m UNION ALL
    SELECT w.k + 1, w.topic, w.size, w.i, w.j, CASE WHEN w.i = w.j OR w.i = w.k + 1 OR w.j = w.k + 1 THEN w.p ELSE greatest(w.p, least(x.p, y.p)) END
    FROM walk w JOIN walk x ON x.topic = w.topic AND x.i = w.i AND x.j = w.k + 1 JOIN walk y ON y.topic = w.topic AND y.i = w.k + 1 AND y.j = w.j WHERE w.k < w.size),
paths AS (SELECT topic, i, j, p FROM walk WHERE k = size),
wins AS (SELECT x.topic, x.i, count(*) FILTER (x.p > y.p) AS wins, count(*) FILTER (x.p < y.p) AS losses FROM paths x JOIN paths y ON x.topic = y.topic AND x.i = y.j AND x.j = y.i AND x.i <> x.j GROUP BY ALL),
ranked AS (SELECT topic, candidate, i, wins, losses, row_number() OVER (PARTITION BY topic ORDER BY wins DESC, candidate DESC) AS rank FROM wins JOIN c USING (topic, i)),
nexts AS (SELECT *, lead(i) OVER (PARTITION BY topic ORDER BY rank) AS nx FROM ranked)
SELECT nexts.topic, candidate, wins, losses, rank, p AS strength FROM nexts LEFT JOIN paths ON nexts.topic = paths.topic AND nexts.i = paths.i AND nexts.nx = paths.j""",
    "pbt",
    recursive=True,
)
def g05_schulze_by_topic(spark, d):
    from ..session import table

    orders = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    counts = orders.groupBy(F.col("c_mktsegment").alias("topic"), F.col("o_custkey").alias("ballot"), F.col("o_orderpriority").alias("candidate")).agg(F.count("*").alias("n"))
    rows = counts.groupBy("topic", "ballot").agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "candidate"))), lambda x: x["candidate"]).alias("ranking"))
    return social_choice.schulze(rows, ["topic"])


def _pav_sql(k: int) -> str:
    ctes = ["c AS (SELECT DISTINCT proposition AS p FROM pv)", "s0 AS (SELECT participant_id, 0.0 AS depth FROM (SELECT DISTINCT participant_id FROM pm))"]
    for i in range(1, k + 1):
        taken = "".join(f" AND p NOT IN (SELECT p FROM b{j})" for j in range(1, i))
        ctes.append(
            f"b{i} AS (SELECT p, {i} AS place, round(score, 6) AS score FROM (SELECT c.p, coalesce(sum(1.0 / (1 + depth)), 0) AS score FROM c LEFT JOIN (pm JOIN s{i - 1} USING (participant_id)) ON pm.proposition = c.p AND approved > 0 WHERE true{taken} GROUP BY c.p) ORDER BY round(score, 9) DESC, p LIMIT 1)"
        )
        ctes.append(f"s{i} AS (SELECT s.participant_id, s.depth + coalesce(m.approved, 0) AS depth FROM s{i - 1} s LEFT JOIN (SELECT pm.* FROM pm JOIN b{i} ON proposition = p) m ON s.participant_id = m.participant_id)")
    return "+" + ", ".join(ctes) + " " + " UNION ALL ".join(f"SELECT p AS proposition, place, score FROM b{i}" for i in range(1, k + 1))


@query(_pav_sql(3), "pv", "pm")
def g08_pav_slate(spark, d):
    slate = social_choice.pav_slate(pv(spark, d), EVENT_TYPES, 3)
    return spark.createDataFrame([(p, i, round(s, 6)) for i, (p, s) in enumerate(slate, 1)], "proposition string, place int, score double")


@query()
def g09_schulze_pav(spark, d):
    slate = social_choice.schulze_pav(pb(spark, d), pv(spark, d), EVENT_TYPES, 3)
    return spark.createDataFrame([(p, i) for i, (p, _) in enumerate(slate, 1)], "proposition string, place int")


def _greedy_sql(k: int) -> str:
    ctes = ["a AS (SELECT DISTINCT participant_id, proposition FROM pvs WHERE approved)"]
    for i in range(1, k + 1):
        seen = " UNION ".join(f"SELECT participant_id FROM a JOIN b{j} USING (proposition)" for j in range(1, i)) or "SELECT -1 AS participant_id WHERE false"
        taken = " UNION ".join(f"SELECT proposition FROM b{j}" for j in range(1, i)) or "SELECT '' AS proposition WHERE false"
        ctes.append(
            f"b{i} AS (SELECT proposition, {i} AS place, count(*) AS represented FROM a WHERE participant_id NOT IN ({seen}) AND proposition NOT IN ({taken}) AND proposition <> 'Other' GROUP BY proposition ORDER BY represented DESC, proposition LIMIT 1)"
        )
    return "+" + ", ".join(ctes) + " " + " UNION ALL ".join(f"SELECT * FROM b{i}" for i in range(1, k + 1))


@query(_greedy_sql(3), "pvs")
def g10_greedy_representation(spark, d):
    votes = pvs(spark, d)
    names = sorted(r[0] for r in votes.select("proposition").distinct().collect())
    chosen = social_choice.greedy_representation(votes, names, 3)
    return spark.createDataFrame([(p, i, n) for i, (p, n) in enumerate(chosen, 1)], "proposition string, place int, represented bigint")


@query(
    """+r AS (SELECT *, 'Topic' FROM pw) SELECT participant_id, 'Priority' AS topic, string_agg(priority, '>' ORDER BY n DESC, priority) AS ranking FROM r GROUP BY participant_id""",
    "pw",
)
def r05_ballots_from_wide(spark, d):
    return B.ballots(pw(spark, d)).select("participant_id", "topic", F.array_join("ranking", ">").alias("ranking"))


@query("SELECT participant_id, 1 AS set_no, 'Priority' AS topic, priority AS statement, CAST(-n AS DOUBLE) AS rank FROM pw", "pw")
def r03_ranked_items(spark, d):
    return B.ranked_items(pw(spark, d)).select("participant_id", "set_no", "topic", "statement", "rank")


@query()
def r24_participant_records(spark, d):
    return B.participant_record(pw(spark, d))


@query("SELECT event_id, CASE WHEN value / 10 > 3 THEN true WHEN value / 10 < 2 THEN false END AS agrees FROM events")
def f14_agreement_map(spark, d):
    from ..session import table

    return table(spark, d, "events").select("event_id", B.agreement(F.col("value") / 10).alias("agrees"))


# --- named queries: propositions of a segment are its customers' brands ------------------------------------------------

VIEWS["sp"] = """seg AS (SELECT c_mktsegment AS topic, o_custkey AS participant_id, p_brand AS proposition, l_quantity, l_returnflag <> 'R' AS approved
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN customer ON o_custkey = c_custkey),
    pos AS (SELECT topic, proposition, row_number() OVER (PARTITION BY topic ORDER BY sum(l_quantity) DESC, proposition) AS s, row_number() OVER (PARTITION BY topic ORDER BY count(*) DESC, proposition) AS p FROM seg GROUP BY topic, proposition),
    mean AS (SELECT participant_id, proposition, avg(CASE WHEN approved THEN 1.0 ELSE 0.0 END) AS a FROM seg GROUP BY ALL),
    rate AS (SELECT proposition, round(sum(a) / (SELECT count(DISTINCT participant_id) FROM mean), 6) AS approval_rate FROM mean GROUP BY proposition)"""


def _world(spark, d, level: str):
    """Propositions, rankings and votes of a level; the upper half of the first ranking is selected."""
    from ..session import table
    from .registry import _sales

    seg = _sales(spark, d).join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(F.col("c_mktsegment").alias("topic"), F.col("o_custkey").alias("participant_id"), F.col("p_brand").alias("proposition"), "l_quantity", (F.col("l_returnflag") != "R").alias("approved"))
    sums = seg.groupBy("topic", "proposition").agg((-F.sum("l_quantity")).alias("q"), (-F.count("*")).alias("c"))
    ranking = lambda by, m: sums.groupBy("topic").agg(F.transform(F.array_sort(F.collect_list(F.struct(by, "proposition"))), lambda x: x["proposition"]).alias("ranking")).select(F.lit(level).alias("level"), "topic", F.lit(None).cast("string").alias("opinion"), F.lit(m).alias("method"), "ranking")
    rankings = ranking("q", "schulze").unionAll(ranking("c", "pav"))
    chosen = rankings.where("method = 'pav'").select("level", "topic", "opinion", F.posexplode("ranking").alias("idx", "proposition"))
    return chosen.withColumn("selected", F.col("idx") < 10), rankings, seg.select("participant_id", "proposition", "approved")


def _shown(df):
    return df.select("topic", "proposition", "rank", "schulze_rank", "pav_rank", F.round("approval_rate", 6).alias("approval_rate"))


@query("SELECT topic, proposition, p AS rank, s AS schulze_rank, p AS pav_rank, approval_rate FROM pos JOIN rate USING (proposition) WHERE p <= 5", "sp")
def q02_selected_by_topic(spark, d):
    return _shown(world.selected_by_topic(*_world(spark, d, "topic"), 5))


@query("SELECT topic, proposition, p AS rank, s AS schulze_rank, p AS pav_rank, approval_rate FROM pos JOIN rate USING (proposition)", "sp")
def q09_all_by_topic(spark, d):
    return _shown(world.all_by_topic(*_world(spark, d, "topic")))


VIEWS["so"] = """sego AS (SELECT c_mktsegment AS topic, l_linestatus AS opinion, o_custkey AS participant_id, p_brand AS proposition, l_quantity, l_returnflag <> 'R' AS approved
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN customer ON o_custkey = c_custkey),
    poso AS (SELECT topic, opinion, proposition, row_number() OVER (PARTITION BY topic, opinion ORDER BY sum(l_quantity) DESC, proposition) AS s,
        row_number() OVER (PARTITION BY topic, opinion ORDER BY count(*) DESC, proposition) AS p FROM sego GROUP BY topic, opinion, proposition),
    meano AS (SELECT participant_id, proposition, avg(CASE WHEN approved THEN 1.0 ELSE 0.0 END) AS a FROM sego GROUP BY ALL),
    rateo AS (SELECT proposition, round(sum(a) / (SELECT count(DISTINCT participant_id) FROM meano), 6) AS approval_rate FROM meano GROUP BY proposition)"""

#: Opinions that have no approval ranking: their first rank is the Schulze rank.
BY_OPINION = """SELECT topic, opinion, proposition, CASE WHEN opinion < 'M' THEN p ELSE s END AS rank, s AS schulze_rank, CASE WHEN opinion < 'M' THEN p END AS pav_rank, approval_rate
FROM poso JOIN rateo USING (proposition)"""


def _by_opinion(spark, d):
    """As ``_world``, by topic and opinion (the line status); only some opinions have an approval ranking."""
    from ..session import table
    from .registry import _sales

    lines = _sales(spark, d, "l_linestatus").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    seg = lines.select(F.col("c_mktsegment").alias("topic"), F.col("l_linestatus").alias("opinion"), F.col("o_custkey").alias("participant_id"), F.col("p_brand").alias("proposition"), "l_quantity", (F.col("l_returnflag") != "R").alias("approved"))
    sums = seg.groupBy("topic", "opinion", "proposition").agg((-F.sum("l_quantity")).alias("q"), (-F.count("*")).alias("c"))
    listed = lambda by: F.transform(F.array_sort(F.collect_list(F.struct(by, "proposition"))), lambda x: x["proposition"])
    both = sums.groupBy("topic", "opinion").agg(listed("q").alias("schulze"), listed("c").alias("pav"))
    methods = F.filter(F.array(*(F.struct(F.lit(m).alias("method"), F.col(m).alias("ranking")) for m in ("schulze", "pav"))), lambda x: (x["method"] == "schulze") | (F.col("opinion") < "M"))
    rankings = both.select(F.lit("opinion").alias("level"), "topic", "opinion", F.inline(methods))
    propositions = sums.select(F.lit("opinion").alias("level"), "topic", "opinion", F.lit(0).alias("idx"), "proposition", F.lit(False).alias("selected"))
    return propositions, rankings, seg.select("participant_id", "proposition", "approved")


def _shown_by_opinion(df):
    return df.select("topic", "opinion", "proposition", "rank", "schulze_rank", "pav_rank", F.round("approval_rate", 6).alias("approval_rate"))


@query(f"SELECT * FROM ({BY_OPINION}) WHERE rank <= 3", "so")
def q01_selected_by_opinion(spark, d):
    return _shown_by_opinion(world.selected_by_opinion(*_by_opinion(spark, d), 3))


@query(BY_OPINION, "so")
def q08_all_by_opinion(spark, d):
    return _shown_by_opinion(world.selected_by_opinion(*_by_opinion(spark, d)))


@query("SELECT 'Nuanced' AS topic, proposition, p AS rank, s AS schulze_rank, p AS pav_rank, approval_rate FROM pos JOIN rate USING (proposition) WHERE p <= 10 AND p <= 4", "sp")
def q03_selected_nuanced(spark, d):
    return _shown(world.selected_nuanced(*_world(spark, d, "nuanced"), 4))


@query("SELECT topic, proposition, p AS rank, s AS schulze_rank, p AS pav_rank, approval_rate, 'pav' AS method FROM pos JOIN rate USING (proposition)", "sp")
def q10_all_nuanced(spark, d):
    return world.all_nuanced(*_world(spark, d, "nuanced")).select("topic", "proposition", "rank", "schulze_rank", "pav_rank", F.round("approval_rate", 6).alias("approval_rate"), "method")


@query(
    """+x AS (SELECT topic, proposition, p AS rank FROM pos WHERE p <= 2 UNION ALL SELECT 'Nuanced', proposition, p FROM pos WHERE p <= 1) SELECT topic, proposition, rank FROM x""", "sp"
)
def q04_selected_propositions(spark, d):
    p, r, v = _world(spark, d, "topic")
    p2, r2, _ = _world(spark, d, "nuanced")
    return world.selected_propositions(p.unionAll(p2), r.unionAll(r2), v, 2, 1).select("topic", "proposition", "rank")


def _draft_rows(spark, d):
    p, _, _ = _world(spark, d, "topic")
    rows = dedup.with_ids(p.select("topic", F.lit(0).alias("r1_quotes"), "idx", "proposition", (F.col("idx") + 1).alias("rank")))
    # A brand in several topics is the same proposition there.
    sets = rows.groupBy("proposition").agg(F.array_sort(F.collect_list("proposition_id")).alias("members")).select(F.col("proposition").alias("set_id"), "members")
    return rows, sets


@query()
def g12_rank_filling_draft(spark, d):
    rows, sets = _draft_rows(spark, d)
    return dedup.rank_filling(rows, sets, 3)


@query(
    """+t AS (SELECT topic, row_number() OVER (ORDER BY topic) - 1 AS topic_id FROM (SELECT DISTINCT topic FROM pos)),
w AS (SELECT proposition, arg_min(topic, p * 100 + topic_id) AS winner FROM pos JOIN t USING (topic) GROUP BY proposition),
k AS (SELECT topic, proposition, p AS rank, winner <> topic AS duplicate, topic_id || ':' || (p - 1) AS proposition_id FROM pos JOIN w USING (proposition) JOIN t USING (topic)),
s AS (SELECT topic, proposition_id FROM (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY rank, proposition_id) AS r FROM k WHERE NOT duplicate) WHERE r <= 3)
SELECT topic, proposition_id, proposition, duplicate, (topic, proposition_id) IN (SELECT (topic, proposition_id) FROM s) AS selected FROM k""",
    "sp",
)
def g17_winning_topics(spark, d):
    rows, sets = _draft_rows(spark, d)
    return dedup.winning_topics(rows, sets, 3).select("topic", "proposition_id", "proposition", "duplicate", "selected")
