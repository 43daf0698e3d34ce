"""Queries: survey intake, moderation, joins, set operators, batches, codecs over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import codecs
from ..functions import text as T
from ..operators import ballots as B
from ..operators import basics, batching, evals, intake, statements
from ..session import table
from .registry import digest_share, digest_share_sql, pmod, pq, ps, pw, query, tagged


@query("SELECT * FROM tagged", "ps", "tagged")
def r09_survey_text(spark, d):
    return tagged(spark, d)


@query("SELECT conv_id, string_agg('Response ' || r || ': ' || answer, chr(10) || chr(10) ORDER BY r) AS response_text FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS r FROM ps) GROUP BY conv_id", "ps")
def r09_response_text(spark, d):
    listed = ps(spark, d).groupBy("conv_id").agg(basics.ordered_list("answer", "turn").alias("a"))
    return listed.select("conv_id", F.array_join(F.transform("a", lambda x, i: F.concat(F.lit("Response "), (i + 1).cast("string"), F.lit(": "), x)), "\n\n").alias("response_text"))


@query(
    r"""SELECT conv_id, CAST(len(regexp_extract_all(survey_text, '<question>([^\n]*?)</question>\s*<response>([^\n]*?)</response>', 2)) AS BIGINT) AS n,
    array_to_string(regexp_extract_all(survey_text, '<question>([^\n]*?)</question>\s*<response>([^\n]*?)</response>', 2), '|') AS responses FROM tagged""",
    "ps",
    "tagged",
)
def f05_single_line_responses(spark, d):
    found = tagged(spark, d).select("conv_id", T.single_line_responses(F.col("survey_text")).alias("r"))
    return found.select("conv_id", F.size("r").cast("bigint").alias("n"), F.array_join("r", "|").alias("responses"))


@query(
    r"""SELECT conv_id, array_to_string(list_transform(list_filter(list_transform(regexp_extract_all(survey_text, '(?s)<response>(.*?)</response>', 1), lambda x: trim(x)), lambda x: x <> ''),
    lambda x: CASE WHEN regexp_matches(x, '[.?!]$') THEN x ELSE x || '.' END), ' ') AS joined FROM tagged""",
    "ps",
    "tagged",
)
def f06_joined_responses(spark, d):
    return tagged(spark, d).select("conv_id", T.joined_responses(F.col("survey_text")).alias("joined"))


@query("SELECT conv_id, turn, answer <> '' AND trim(answer) <> '' AND try_cast(answer AS DOUBLE) IS NULL AS is_text FROM ps", "ps")
def p10_text_responses(spark, d):
    return ps(spark, d).select("conv_id", "turn", T.is_text_response(F.col("answer")).alias("is_text"))


@query(
    """SELECT c_custkey AS ord, CAST(row_number() OVER (ORDER BY c_custkey) AS VARCHAR) AS participant_id FROM customer"""
)
def p02_respondent_ids_numbered(spark, d):
    rows = table(spark, d, "customer").select(F.col("c_custkey").alias("ord"), F.when(F.col("c_custkey") % 7 > 0, F.col("c_name")).alias("rid"))
    return intake.with_respondent_ids(rows).select("ord", "participant_id")


@query("SELECT c_custkey AS ord, CASE WHEN c_custkey % 7 > 0 THEN c_name ELSE c_mktsegment END AS participant_id FROM customer")
def p02_respondent_ids_second(spark, d):
    rows = table(spark, d, "customer").select(F.col("c_custkey").alias("ord"), F.when(F.col("c_custkey") % 7 > 0, F.col("c_name")).alias("rid"), F.col("c_mktsegment").alias("rdud"))
    return intake.with_respondent_ids(rows).select("ord", "participant_id")


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'O' AND (o_orderpriority IS NULL OR o_orderpriority <> '5-LOW')")
def p01_finished_rows(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "O", "False").otherwise("True").alias("Finished"), F.when(F.col("o_orderpriority") == "5-LOW", "Survey Preview").otherwise("IP Address").alias("Status"))
    return intake.finished(rows).select("o_orderkey")


@query("+q AS (SELECT quantile_cont(duration, 0.9) AS q FROM pmod) SELECT row_id, round(greatest(0, least(1, 1 - duration / q)), 6) AS too_fast FROM pmod, q", "pmod")
def a18_too_fast(spark, d):
    return intake.too_fast(pmod(spark, d), "duration").select("row_id", F.round("too_fast", 6).alias("too_fast"))


@query("SELECT row_id, 1.0 - CAST(quality AS DOUBLE) / max(quality) OVER () AS spam FROM pmod", "pmod")
def a19_spamminess(spark, d):
    return intake.spamminess(pmod(spark, d), "quality").select("row_id", "spam")


SNIPPETS = f"+s AS (SELECT doc_id AS row_id, unnest(list_filter(string_split(text, chr(10)), lambda x: x <> '')) AS snippet FROM documents) SELECT row_id, max({digest_share_sql('snippet')}) AS toxicity, max({digest_share_sql(chr(39) + 'x' + chr(39) + ' || snippet')}) AS threat FROM s GROUP BY row_id"


@query(SNIPPETS)
def a15_snippet_maxima(spark, d):
    rows = table(spark, d, "documents").select(F.col("doc_id").alias("row_id"), "text")
    other = F.conv(F.substring(F.md5(F.concat(F.lit("x"), "snippet").cast("binary")), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)
    return intake.snippet_maxima(rows, F.filter(F.split("text", "\n"), lambda x: x != ""), {"toxicity": digest_share("snippet"), "threat": other}).drop("text")


@query("SELECT row_id, greatest(quality, toxic) AS max_score FROM pmod", "pmod")
def a17_moderation_order(spark, d):
    return intake.moderation_order(pmod(spark, d).withColumn("ord", F.col("row_id")), ["quality", "toxic"]).select("row_id", F.col("max_score").cast("int").alias("max_score"))


@query("SELECT row_id, CAST(coalesce(quality, 0) + coalesce(toxic, 0) + duration AS DOUBLE) / (1 + CASE WHEN quality IS NULL THEN 0 ELSE 2 END) AS mean FROM pmod", "pmod")
def a16_row_means(spark, d):
    return pmod(spark, d).select("row_id", basics.row_mean(["quality", "toxic", "duration"]).alias("mean"))


@query(
    r"""SELECT doc_id AS row_id, array_to_string(list_sort(list_distinct(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}')))[1:3], chr(10)) AS EMAIL_ADDRESS,
    array_to_string(list_sort(list_distinct(regexp_extract_all(text, '\b\d{4}[ -]?\d{4}[ -]?\d{4}[ -]?\d{4}\b')))[1:3], chr(10)) AS CREDIT_CARD_NUMBER FROM documents"""
)
def a31_personal_data(spark, d):
    rows = table(spark, d, "documents").select(F.col("doc_id").alias("row_id"), "text")
    return intake.findings(rows, {k: intake.PERSONAL[k] for k in ("EMAIL_ADDRESS", "CREDIT_CARD_NUMBER")})


# --- joins -----------------------------------------------------------------------------------------------------------


ROUNDS = """+a AS (SELECT c_custkey AS participant_id, c_mktsegment AS said FROM customer WHERE c_custkey % 3 > 0), b AS (SELECT o_custkey AS participant_id, max(o_orderpriority) AS said FROM orders GROUP BY 1)"""


def _rounds(spark, d):
    a = table(spark, d, "customer").where("c_custkey % 3 > 0").select(F.col("c_custkey").alias("participant_id"), F.col("c_mktsegment").alias("said"))
    b = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("participant_id")).agg(F.max("o_orderpriority").alias("said"))
    return a, b


@query(ROUNDS + " SELECT coalesce(a.participant_id, b.participant_id) AS participant_id, a.said AS said_r1, b.said AS said_r2, CASE WHEN a.participant_id IS NULL THEN 'right_only' WHEN b.participant_id IS NULL THEN 'left_only' ELSE 'both' END AS _merge FROM a FULL JOIN b ON a.participant_id = b.participant_id")
def j02_rounds_full_outer(spark, d):
    return basics.full_outer(*_rounds(spark, d), "participant_id", ("_r1", "_r2"), "_merge")


@query(ROUNDS + " SELECT count(a.participant_id) AS in_r1, count(b.participant_id) AS in_r2, count(*) FILTER (a.participant_id IS NOT NULL AND b.participant_id IS NOT NULL) AS in_both FROM a FULL JOIN b ON a.participant_id = b.participant_id")
def a29_round_overlap(spark, d):
    return intake.round_overlap(*_rounds(spark, d))


@query(ROUNDS + " SELECT coalesce(a.participant_id, b.participant_id) AS participant_id, a.said AS said_r1, b.said AS said_r2 FROM a FULL JOIN b ON a.participant_id = b.participant_id")
def q05_participant_data(spark, d):
    from ..operators import world

    a, b = _rounds(spark, d)
    return world.participant_data(*(x.unionAll(x.withColumn("said", F.lit("later"))).withColumn("ord", F.when(F.col("said") == "later", 1).otherwise(0)) for x in (a, b)))


@query(ROUNDS + " SELECT coalesce(a.participant_id, b.participant_id) AS participant_id, coalesce(a.said, b.said) AS said FROM a FULL JOIN b ON a.participant_id = b.participant_id")
def j17_coalesced(spark, d):
    return basics.coalesced(_rounds(spark, d), "participant_id")


@query("SELECT row_id, duration, quality, toxic FROM pmod", "pmod")
def j05_validated_join(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.col("n_chars").alias("duration"))
    return basics.validated_one_to_one(docs, table(spark, d, "labels"), "doc_id").withColumnRenamed("doc_id", "row_id")


@query("SELECT doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def j13_semi(spark, d):
    return table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels").where("toxic = 1"), "doc_id", "left_semi")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def j14_missing_replies(spark, d):
    return table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels"), "doc_id", "left_anti")


@query("SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey")
def j16_looked_up(spark, d):
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return basics.looked_up(table(spark, d, "customer"), n, "c_nationkey").select("c_custkey", "n_name")


@query(
    """+s AS (SELECT topic, opinion, quote AS proposition, max(ord % 5) AS o FROM pq GROUP BY ALL), t AS (SELECT topic, quote AS proposition, max(ord % 3) AS t FROM pq GROUP BY ALL)
SELECT s.topic, s.opinion, s.proposition, s.o AS opinion_score, t.t AS topic_score FROM s JOIN t ON s.topic = t.topic AND s.proposition = t.proposition""",
    "pq",
)
def v10_proposition_scores(spark, d):
    rows = pq(spark, d).select("topic", "opinion", F.col("quote").alias("proposition"), "ord")
    o = rows.select("topic", "opinion", "proposition", (F.col("ord") % 5).alias("score"))
    t = rows.select("topic", "proposition", (F.col("ord") % 3).alias("score"))
    return evals.proposition_scores(rows.select("topic", "opinion", "proposition").distinct().withColumn("topic_score", F.lit(9)), t, o)


@query(
    """+q AS (SELECT participant_id AS statement_id, ord, topic, participant_id || '-' || ord AS quote_id FROM pq),
k AS (SELECT *, count(*) OVER (PARTITION BY statement_id, topic) AS n FROM q)
SELECT quote_id, CASE WHEN ord % 2 = 0 THEN 'E' || ord WHEN n = 1 THEN 'L' || statement_id END AS opinion FROM k""",
    "pq",
)
def j20_loose_matches(spark, d):
    q = pq(spark, d).select(F.col("participant_id").alias("statement_id"), "ord", "topic", F.concat_ws("-", F.col("participant_id").cast("string"), F.col("ord").cast("string")).alias("quote_id"))
    exact = q.where("ord % 2 = 0").select("statement_id", "quote_id", "topic", F.array(F.concat(F.lit("E"), F.col("ord").cast("string"))).alias("opinions"))
    loose = q.select("statement_id", F.lit(None).cast("string").alias("quote_id"), "topic", F.array(F.concat(F.lit("L"), F.col("statement_id").cast("string"))).alias("opinions"))
    return statements.opinions_on_quotes(q, exact.unionByName(loose)).select("quote_id", F.try_element_at("opinions", F.lit(1)).alias("opinion"))


@query("SELECT participant_id, arg_min(quote, ord) AS text, string_agg(DISTINCT topic, ';' ORDER BY topic) AS topics, count(*) AS quotes FROM pq GROUP BY participant_id", "pq")
def r13_statements(spark, d):
    rows = statements.statements(pq(spark, d).withColumn("survey_text", F.col("quote")))
    return rows.select("participant_id", "text", F.array_join(F.array_sort("topics"), ";").alias("topics"), F.size("quotes").cast("bigint").alias("quotes"))


@query("SELECT doc_id, sum(length(text)) OVER (PARTITION BY doc_id) // 4 > 500 AS skipped FROM documents")
def p07_oversized(spark, d):
    rows = table(spark, d, "documents").select(F.col("doc_id"), "text", F.array().cast("array<struct<text:string>>").alias("quotes"))
    kept, skipped = statements.split_oversized(rows, 500)
    return kept.select("doc_id", F.lit(False).alias("skipped")).unionAll(skipped.select("doc_id", F.lit(True)))


@query("SELECT participant_id, proposition FROM (SELECT DISTINCT participant_id, opinion AS proposition FROM pq UNION SELECT participant_id, 'verbatim' FROM pq)", "pq")
def u02_appended(spark, d):
    lists = pq(spark, d).groupBy("participant_id").agg(F.collect_set("opinion").alias("p"))
    return lists.select("participant_id", F.explode(basics.appended_if_absent(basics.appended_if_absent(F.col("p"), F.lit("verbatim")), F.lit("verbatim"))).alias("proposition"))


# --- batches, codecs, translations -----------------------------------------------------------------------------------


@query(
    """+t AS (SELECT doc_id AS ord, length(text) // 4 + 5 AS cost, doc_id // 2000 AS slab, row_number() OVER (PARTITION BY doc_id // 2000 ORDER BY doc_id) AS r FROM documents),
w(slab, r, ord, batch, tokens, items) AS (SELECT slab, r, ord, 0, cost, 1 FROM t WHERE r = 1 UNION ALL
    SELECT t.slab, t.r, t.ord, CASE WHEN items >= 5 OR tokens + cost > 1000 THEN batch + 1 ELSE batch END, CASE WHEN items >= 5 OR tokens + cost > 1000 THEN cost ELSE tokens + cost END,
    CASE WHEN items >= 5 OR tokens + cost > 1000 THEN 1 ELSE items + 1 END FROM w JOIN t ON t.slab = w.slab AND t.r = w.r + 1)
SELECT ord, slab, batch FROM w""",
    recursive=True,
)
def b01_token_batches(spark, d):
    rows = table(spark, d, "documents").select(F.col("doc_id").alias("ord"), "text")
    return batching.token_batches(rows, tokens=1000, most=5).select("ord", "batch.slab", F.col("batch.n").alias("batch"))


@query("SELECT c_custkey AS ord, (row_number() OVER (ORDER BY c_custkey) - 1) // 7 AS batch FROM customer")
def b03_fixed_batches(spark, d):
    rows = table(spark, d, "customer").select(F.col("c_custkey").alias("ord"))
    return batching.fixed_batches(rows, 7).select("ord", F.col("batch").cast("bigint").alias("batch"))


@query()
def b04_jury_jobs(spark, d):
    people = table(spark, d, "customer").select(F.col("c_custkey").alias("participant_id"))
    return batching.jury_jobs(people, [f"statement {i}" for i in range(7)], 3)


@query("SELECT CAST(round(0.02 * count(*)) AS BIGINT) AS n FROM customer")
def b05_jury_sample(spark, d):
    people = table(spark, d, "customer").select(F.col("c_custkey").alias("participant_id"))
    return batching.sampled(people, 0.02).agg(F.count("*").alias("n"))


@query("SELECT 10 AS total, count(DISTINCT opinion) AS opinions FROM pq WHERE topic = 'fr'", "pq")
def b06_allocations(spark, d):
    sizes = pq(spark, d).where("topic = 'fr'").groupBy("topic", "opinion").agg(F.count("*").alias("size"))
    return batching.allocated(sizes, 10).agg(F.sum("allocations").cast("int").alias("total"), F.count("*").alias("opinions"))


@query("SELECT c_custkey, c_mktsegment || ' (' || substr(md5(c_mktsegment), 1, 6) || ')' AS translated FROM customer")
def m23_translation_memo(spark, d):
    from ..operators import pipelines

    rows = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return pipelines.translated(rows, "c_mktsegment", pipelines.digest_translator(spark)).select("c_custkey", F.col("c_mktsegment").alias("translated"))


@query("SELECT ord, CAST(ord % 5 AS DOUBLE) AS score FROM pq", "pq")
def f22_scores_of_replies(spark, d):
    reply = F.concat(F.lit('Sure:\n```json\n{"score": '), (F.col("ord") % 5).cast("string"), F.lit(', "explanation": "x"}\n```'))
    return pq(spark, d).select("ord", codecs.parse_score(reply).alias("score"))


@query("SELECT ord, 'b>a' AS ranking FROM pq", "pq")
def f23_rankings_of_replies(spark, d):
    letters = codecs.lettered(F.array(F.lit("a"), F.lit("b")))
    return pq(spark, d).select("ord", F.array_join(codecs.parse_ranking(F.lit('x {"reasoning": "r", "ranking": ["B", "A"]}'), letters), ">").alias("ranking"))


@query("SELECT ord, true AS a, false AS b FROM pq", "pq")
def f24_votes_of_replies(spark, d):
    letters = codecs.lettered(F.array(F.lit("a"), F.lit("b")))
    reply = F.lit('{"reasoning": "r", "votes": [{"statement_letter": "A", "vote": "Agree"}, {"statement_letter": "B", "vote": "Disagree"}]}')
    votes = codecs.parse_votes(reply, letters, F.array(F.lit("Agree")))
    return pq(spark, d).select("ord", votes["a"].alias("a"), votes["b"].alias("b"))


@query("SELECT ord, 2 AS n, 'first' AS one FROM pq", "pq")
def f28_numbered_lines(spark, d):
    found = codecs.numbered_lines(F.lit("Here:\n1. first\n 2. second\nend"))
    return pq(spark, d).select("ord", F.size(found).alias("n"), F.element_at(found, 1).alias("one"))


@query("SELECT DISTINCT opinion, opinion AS repaired FROM pq UNION ALL SELECT 'nonsense', NULL", "pq")
def f30_repaired_labels(spark, d):
    rows = pq(spark, d).select("opinion").distinct()
    valid = F.array(*(F.lit(f"src{i}") for i in range(1, 20)))
    noisy = rows.unionAll(spark.range(1).select(F.lit("nonsense")))
    return noisy.select("opinion", codecs.repaired_label(F.when(F.col("opinion") == "Other", F.col("opinion")).otherwise(F.concat(F.lit(" "), F.upper("opinion"))), valid).alias("repaired"))


@query("SELECT participant_id, 'Priority' AS topic, n FROM (SELECT participant_id, count(*) AS n FROM pw GROUP BY 1)", "pw")
def v12_pool_check(spark, d):
    items = B.ranked_items(pw(spark, d))
    return items.groupBy("participant_id", "topic").agg(F.count("*").alias("n"))


@query("SELECT value, printf('%.1f%%', value) AS shown FROM (SELECT CAST(c_custkey % 101 AS DOUBLE) / 100 * 100 AS value FROM customer)")
def f16_percent_texts(spark, d):
    share = (F.col("c_custkey") % 101).cast("double") / 100
    return table(spark, d, "customer").select((share * 100).alias("value"), T.percent_text(share).alias("shown"))
