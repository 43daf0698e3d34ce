"""Queries: counts, lists and orders of quotes, topics and opinions; report data."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import codecs
from ..functions import text as T
from ..operators import basics, evals, report
from ..session import table
from ..sources import tables
from .registry import digest_share, digest_share_sql, pd, pq, query

NOT_OTHER = "topic <> 'Other' AND opinion <> 'Other'"


@query(
    f"""+k AS (SELECT * FROM pq WHERE {NOT_OTHER}),
o AS (SELECT topic, opinion, count(*) AS opinion_quotes, min(ord) AS o FROM k GROUP BY ALL),
t AS (SELECT topic, count(DISTINCT quote) AS topic_quotes, min(ord) AS t FROM k GROUP BY ALL)
SELECT topic, opinion, topic_quotes, opinion_quotes, dense_rank() OVER (ORDER BY topic_quotes DESC, t, topic) AS topic_place,
    row_number() OVER (PARTITION BY topic ORDER BY opinion_quotes DESC, o) AS opinion_place FROM o JOIN t USING (topic)""",
    "pq",
)
def a05_topic_tree(spark, d):
    return report.topic_tree(pq(spark, d))


@query(
    f"""+k AS (SELECT * FROM pq WHERE {NOT_OTHER}),
o AS (SELECT topic, opinion, count(*) AS n, min(ord) AS o FROM k GROUP BY ALL),
t AS (SELECT topic, count(DISTINCT quote) AS q, min(ord) AS t FROM k GROUP BY ALL),
p AS (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY n DESC, o) AS op, dense_rank() OVER (ORDER BY q DESC, t, topic) AS tp FROM o JOIN t USING (topic)),
b AS (SELECT tp, any_value(tp || '. ' || topic || ' (' || q || ' quotes)') || chr(10) || string_agg('  ' || op || '. ' || opinion || ' (' || n || ' quotes)', chr(10) ORDER BY op) AS block FROM p GROUP BY tp)
SELECT string_agg(block, chr(10) || chr(10) ORDER BY tp) || chr(10) || chr(10) || 'Total number of unique opinions: ' || (SELECT count(DISTINCT opinion) FROM k) AS text FROM b""",
    "pq",
)
def k08_topic_tree_text(spark, d):
    return report.topic_tree_text(pq(spark, d))


@query(
    """SELECT topic, opinion, count(*) AS quotes, count(DISTINCT CASE WHEN trim(coalesce(quote, '')) <> '' THEN participant_id END) AS participants,
    count(DISTINCT opinion) AS opinions FROM pq GROUP BY ROLLUP (topic, opinion)""",
    "pq",
)
def a20_topic_rollup(spark, d):
    return report.rollup_counts(pq(spark, d))


@query("SELECT topic, opinion, count(*) AS n FROM pq GROUP BY ALL", "pq")
def a01_opinion_sizes(spark, d):
    return pq(spark, d).groupBy("topic", "opinion").agg(F.count("*").alias("n"))


@query("SELECT topic, string_agg(DISTINCT opinion, ';' ORDER BY opinion) AS opinions FROM pq GROUP BY topic", "pq")
def a02_opinions_per_topic(spark, d):
    return tables.taxonomy(pq(spark, d)).select("topic", F.array_join("opinions", ";").alias("opinions"))


@query("+f AS (SELECT topic, opinion, min(ord) AS o FROM pq GROUP BY ALL) SELECT topic, string_agg(opinion, ';' ORDER BY o) AS opinions FROM f GROUP BY topic", "pq")
def s13_taxonomy_in_order(spark, d):
    return tables.taxonomy(pq(spark, d), ordered=True).select("topic", F.array_join("opinions", ";").alias("opinions"))


@query("SELECT topic, quote, string_agg(opinion, '|' ORDER BY ord, opinion) AS opinions FROM pq GROUP BY ALL", "pq")
def a03_opinions_of_quotes(spark, d):
    return pq(spark, d).groupBy("topic", "quote").agg(F.array_join(basics.ordered_list("opinion", "ord", "opinion"), "|").alias("opinions"))


@query(
    """+n AS (SELECT *, row_number() OVER (PARTITION BY participant_id ORDER BY ord) AS r FROM pq)
SELECT participant_id, string_agg(r || '. ' || quote, chr(10) ORDER BY ord) AS quote, arg_min(topic, ord) AS topic, arg_min(opinion, ord) AS opinion FROM n GROUP BY ALL""",
    "pq",
)
def a04_numbered_quotes(spark, d):
    return evals.grouped_numbered(pq(spark, d), "participant_id", "quote")


@query("SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY participant_id ORDER BY ord) AS r FROM pq) WHERE r = 1", "pq")
def w01_first_per_participant(spark, d):
    return basics.first_per(pq(spark, d), ["participant_id"], ["ord"])


@query("SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY quote ORDER BY ord) AS r FROM pq) WHERE r = 1", "pq")
def a12_first_per_text(spark, d):
    return basics.first_per(pq(spark, d), ["quote"], ["ord"])


@query("SELECT quote, min(ord) AS ord FROM pq WHERE quote IS NOT NULL GROUP BY quote", "pq")
def a13_distinct_in_order(spark, d):
    return basics.distinct_in_order(pq(spark, d), "quote")


@query(
    """+o AS (SELECT ord, CASE WHEN ord % 2 = 0 THEN upper(opinion) ELSE opinion END AS opinion FROM pq WHERE lower(opinion) <> 'other')
SELECT opinion, ord FROM (SELECT *, row_number() OVER (PARTITION BY lower(opinion) ORDER BY ord) AS r FROM o) WHERE r = 1""",
    "pq",
)
def a14_distinct_ignoring_case(spark, d):
    rows = pq(spark, d).where("lower(opinion) <> 'other'").select("ord", F.when(F.col("ord") % 2 == 0, F.upper("opinion")).otherwise(F.col("opinion")).alias("opinion"))
    return basics.first_per(rows, [F.lower("opinion")], ["ord"])


@query(
    """+o AS (SELECT topic, quote FROM pq WHERE opinion = 'Other' GROUP BY ALL),
p AS (SELECT topic, string_agg(DISTINCT opinion, ';' ORDER BY opinion) AS opinions FROM pq WHERE opinion <> 'Other' GROUP BY topic) SELECT topic, quote, opinions FROM o JOIN p USING (topic)""",
    "pq",
)
def v04_other_against_opinions(spark, d):
    return evals.other_against_opinions(pq(spark, d)).select("topic", "quote", F.array_join("opinions", ";").alias("opinions"))


@query(
    """+q AS (SELECT topic, quote, string_agg(DISTINCT opinion, ';' ORDER BY opinion) AS assigned FROM pq GROUP BY ALL),
t AS (SELECT topic, string_agg(DISTINCT opinion, ';' ORDER BY opinion) AS opinions FROM pq GROUP BY topic) SELECT topic, quote, assigned, opinions FROM q JOIN t USING (topic)""",
    "pq",
)
def v05_opinion_assignments(spark, d):
    return evals.opinion_assignments(pq(spark, d)).select("topic", "quote", F.array_join("assigned", ";").alias("assigned"), F.array_join("opinions", ";").alias("opinions"))


@query(
    """SELECT quote, topic, opinion AS response FROM (SELECT *, row_number() OVER (PARTITION BY opinion ORDER BY ord) AS r FROM pq WHERE opinion <> 'Other') WHERE r = 1""",
    "pq",
)
def v01_pointwise_dataset(spark, d):
    return evals.pointwise(pq(spark, d), evals.Metric("opinion", ("quote", "topic"), "opinion", "", distinct_by="opinion", drop_other=True))


@query("+c AS (SELECT ord, opinion || '!' AS opinion FROM pq WHERE ord % 3 > 0) SELECT ord, p.opinion AS baseline, c.opinion AS candidate FROM pq p JOIN c USING (ord)", "pq")
def v02_pairwise_dataset(spark, d):
    rows = pq(spark, d)
    return evals.pairwise(rows, rows.where("ord % 3 > 0").withColumn("opinion", F.concat("opinion", F.lit("!"))), "opinion")


@query(f"+s AS (SELECT *, {digest_share_sql('quote')} * 5 AS score FROM pq) SELECT ord, CASE WHEN ord % 7 = 0 THEN 'errored' WHEN score >= 4 THEN 'passed' ELSE 'failed' END AS verdict FROM s", "pq")
def v07_judge_verdicts(spark, d):
    scored = pq(spark, d).withColumn("score", F.when(F.col("ord") % 7 == 0, "n/a").otherwise((digest_share("quote") * 5).cast("string")))
    return evals.judged(scored).select("ord", "verdict")


@query("SELECT topic AS metric, round(avg(CASE WHEN ord % 7 > 0 THEN ord % 5 END), 6) AS mean, count(*) AS n FROM pq GROUP BY topic", "pq")
def a10_score_summary(spark, d):
    scored = pq(spark, d).select(F.col("topic").alias("metric"), F.when(F.col("ord") % 7 == 0, "none").otherwise((F.col("ord") % 5).cast("string")).alias("score"))
    return evals.score_summary(scored).withColumn("mean", F.round("mean", 6))


@query(
    f"""+s AS (SELECT topic, opinion, quote, ord, row_number() OVER (PARTITION BY topic, opinion ORDER BY {digest_share_sql('quote')} DESC NULLS LAST, ord) AS place FROM pq)
SELECT topic, opinion, quote, ord, place FROM s WHERE place <= 4""",
    "pq",
)
def o02_sample_quotes(spark, d):
    return report.sample_quotes(pq(spark, d), digest_share("quote")).select("topic", "opinion", "quote", "ord", "place")


@query(
    """+n AS (SELECT topic, opinion, count(*) AS n, min(ord) AS o FROM pq GROUP BY ALL)
SELECT topic, opinion, n, row_number() OVER (PARTITION BY topic ORDER BY opinion = 'Other', n DESC, o) AS place FROM n""",
    "pq",
)
def o03_opinions_other_last(spark, d):
    return report.opinions_in_order(pq(spark, d))


GROUPS = {"A": [("demo:Segment", "BUILDING")], "B": [("demo:Segment", "MACHINERY"), ("demo:Nation", "NATION_1")], "C": []}


@query(
    """+j AS (SELECT q.*, segment, nation FROM pq q LEFT JOIN pd p ON q.participant_id = p.participant_id),
g AS (SELECT 'A' AS "group", * FROM j WHERE segment = 'BUILDING' UNION ALL SELECT 'B', * FROM j WHERE segment = 'MACHINERY' AND nation = 'NATION_1' UNION ALL SELECT 'C', * FROM j)
SELECT "group", topic, opinion, count(*) AS quotes, count(DISTINCT participant_id) AS participants FROM g GROUP BY ALL""",
    "pq",
    "pd",
)
def a24_compare_groups(spark, d):
    return report.compare_groups(pq(spark, d).join(pd(spark, d).drop("ord"), "participant_id", "left"), GROUPS)


@query(
    """+j AS (SELECT q.*, segment FROM pq q LEFT JOIN pd p ON q.participant_id = p.participant_id),
g AS (SELECT 'A' AS "group", * FROM j WHERE segment = 'BUILDING' UNION ALL SELECT 'C', * FROM j),
c AS (SELECT "group", topic, opinion, count(*) AS quotes, count(DISTINCT participant_id) AS participants FROM g GROUP BY ALL),
t AS (SELECT topic, opinion FROM c WHERE "group" = 'A' ORDER BY quotes DESC, topic, opinion LIMIT 5) SELECT c.* FROM c JOIN t USING (topic, opinion)""",
    "pq",
    "pd",
)
def o07_top_opinions(spark, d):
    joined = pq(spark, d).join(pd(spark, d).drop("ord"), "participant_id", "left")
    return report.top_opinions(report.compare_groups(joined, {k: GROUPS[k] for k in "AC"}), "A", 5)


DEMOGRAPHICS = """c AS (SELECT label, value, count(*) AS n FROM pdl GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY n DESC, value) AS r, count(*) OVER (PARTITION BY label) AS k FROM c),
h AS (SELECT label, CASE WHEN k > 6 AND r > 5 THEN 'Other' ELSE value END AS value, CAST(sum(n) AS BIGINT) AS n FROM r GROUP BY ALL)"""


@query(f"+{DEMOGRAPHICS} SELECT * FROM h", "pd", "pdl")
def a22_demographics_top5(spark, d):
    from ..operators.intake import unpivoted_demographics

    return report.demographics(unpivoted_demographics(pd(spark, d)))


@query(
    f"""+{DEMOGRAPHICS}, p AS (SELECT label, value, n, CAST(round(100.0 * n / sum(n) OVER (PARTITION BY label)) AS BIGINT) AS percent FROM h)
SELECT *, CAST(coalesce(sum(percent) OVER (PARTITION BY label ORDER BY value = 'Other', value ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset" FROM p""",
    "pd",
    "pdl",
)
def a25_percent_and_offset(spark, d):
    return report.percent_and_offset(a22_demographics_top5(spark, d))


@query("SELECT segment, count(*) AS n FROM pd WHERE nation = 'NATION_1' AND segment = 'BUILDING' GROUP BY ALL", "pd")
def p11_all_equal(spark, d):
    rows = basics.all_equal(pd(spark, d), {"`demo:Nation`": "NATION_1", "`demo:Segment`": "BUILDING"})
    return rows.groupBy(F.col("`demo:Segment`").alias("segment")).agg(F.count("*").alias("n"))


@query(
    """+o AS (SELECT topic, opinion, string_agg(quote, '|' ORDER BY ord) AS quotes, count(*) AS n, min(ord) AS o FROM (SELECT *, row_number() OVER (PARTITION BY topic, opinion ORDER BY ord) AS p FROM pq) WHERE p <= 3 GROUP BY ALL)
SELECT topic, string_agg(opinion || '=' || quotes, ';' ORDER BY opinion = 'Other', n DESC, o) AS opinions FROM o GROUP BY topic""",
    "pq",
)
def r21_hierarchy(spark, d):
    tree = report.hierarchy(pq(spark, d), 3)
    return tree.select("topic", F.array_join(F.transform("opinions", lambda x: F.concat(x["opinion"], F.lit("="), F.array_join(x["quotes"], "|"))), ";").alias("opinions"))


@query("SELECT topic, opinion, quote FROM pq", "pq")
def r22_flattened(spark, d):
    return report.flat(report.hierarchy(pq(spark, d)))


@query()
def r23_report_json(spark, d):
    return report.report_json(report.hierarchy(pq(spark, d), 2), "overview")


@query()
def g19_topic_samples(spark, d):
    return report.topic_samples(pq(spark, d), score=digest_share("quote"))


@query(
    """+s AS (SELECT DISTINCT '## ' || topic AS title FROM pq), t AS (SELECT DISTINCT topic FROM pq)
SELECT t.topic, 'about ' || t.topic AS summary FROM t JOIN s ON s.title = '## ' || t.topic""",
    "pq",
)
def j19_topic_summaries(spark, d):
    topics = pq(spark, d).select("topic").distinct()
    summaries = topics.select(F.concat(F.lit("## "), "topic").alias("title"), F.concat(F.lit("about "), "topic").alias("summary"), F.lit(0).alias("ord"))
    return report.with_summaries(topics, summaries)


@query("SELECT ord, coalesce(nullif(regexp_replace(strip_accents(lower(quote)), '[^\\p{L}\\p{N}]+', '', 'g'), ''), 'item') AS id FROM pq", "pq")
def f18_slug_ids(spark, d):
    return pq(spark, d).select("ord", T.slug(F.col("quote")).alias("id"))


@query("SELECT ord, 'T' || (ord % 3) || ':' || least(opinion, 'Z' || opinion) || ';' || 'T' || (ord % 3) || ':' || greatest(opinion, 'Z' || opinion) || ';' || 'U' AS codec FROM pq", "pq")
def f09_topics_codec(spark, d):
    text = F.concat(F.lit(" U ; T"), (F.col("ord") % 3).cast("string"), F.lit(":Z"), "opinion", F.lit(";T"), (F.col("ord") % 3).cast("string"), F.lit(":"), "opinion", F.lit(";;U"))
    return pq(spark, d).select("ord", codecs.concat_topics(codecs.parse_topics(text)).alias("codec"))


@query("SELECT topic, opinion, ord FROM pq WHERE topic <> 'Other' AND opinion <> 'Other' AND topic <> 'fr'", "pq")
def p05_without_other(spark, d):
    return report.excluded(basics.without_other(pq(spark, d)), topics=["fr"]).select("topic", "opinion", "ord")


@query(
    """+x AS (SELECT topic AS t FROM pq UNION SELECT opinion FROM pq UNION SELECT unnest(['en', 'climate'])) SELECT t AS text FROM x WHERE trim(t) <> ''""",
    "pq",
)
def u06_union_of_topics(spark, d):
    given = spark.sql("SELECT explode(split('en,climate', ',')) AS topic, CAST(NULL AS string) AS opinion")
    return basics.distinct_texts(pq(spark, d).select("topic", "opinion").unionAll(given), ["topic", "opinion"])


@query("SELECT doc_id, length(text) // 4 AS tokens FROM documents")
def f12_token_estimate(spark, d):
    return table(spark, d, "documents").select("doc_id", T.estimated_tokens(F.col("text")).alias("tokens"))


@query("SELECT ord, '<item>' || replace(replace(replace(quote, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || '</item>' AS item FROM pq", "pq")
def f20_prompt_items(spark, d):
    return pq(spark, d).select("ord", T.prompt_item(F.col("quote")).alias("item"))


@query("SELECT topic, string_agg('- ' || opinion, chr(10) ORDER BY opinion) AS bullets FROM (SELECT DISTINCT topic, opinion FROM pq) GROUP BY topic", "pq")
def f38_bullets(spark, d):
    return tables.taxonomy(pq(spark, d)).select("topic", T.bullets(F.col("opinions")).alias("bullets"))


@query("SELECT ord, translate(replace(quote, '\"', ''), chr(10), ' ') AS quote FROM pq", "pq")
def f36_clean_quotes(spark, d):
    return pq(spark, d).select("ord", T.clean_quote(F.col("quote")).alias("quote"))


@query("SELECT ord, participant_id || '-' || topic AS quote_id FROM pq", "pq")
def f34_quote_ids(spark, d):
    from ..operators.statements import quote_id

    return pq(spark, d).select("ord", quote_id(F.col("participant_id"), F.col("topic")).alias("quote_id"))
