"""Queries: sources and sinks as round trips through files, validation, reshaping, checks of records."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import codecs
from ..functions import text as T
from ..operators import ballots as B
from ..operators import basics, batching, dedup, evals, inference, intake, lifecycle, refinement, report, social_choice, statements
from ..session import table, work_dir
from ..sources import sinks, tables
from .registry import pd, pq, pv, query

NATION = "SELECT n_nationkey, n_name, n_regionkey FROM nation"


def _nation_csv(spark, d):
    path = work_dir(spark)
    sinks.write_csv(table(spark, d, "nation"), path)
    return path


@query(NATION)
def s01_csv_scan(spark, d):
    return tables.read_csv(spark, _nation_csv(spark, d), infer=True).select("n_nationkey", "n_name", "n_regionkey")


@query("SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name FROM nation")
def s02_csv_text_scan(spark, d):
    # One file, as exports are: its order is the rows' order.
    path = work_dir(spark)
    table(spark, d, "nation").select("n_nationkey", F.col("n_name").alias("N_NAME")).coalesce(1).write.options(header=True).csv(path)
    return tables.read_csv_text(spark, path).select("n_nationkey", "n_name")


@query("SELECT n_name FROM nation")
def s04_projected_scan(spark, d):
    return tables.read_csv(spark, _nation_csv(spark, d), ["n_name"])


def _export(spark, d):
    path = work_dir(spark)
    head = ["Finished,Status,rid,Q1,Q2", 'f,s,r,"Why, then?",Where', ",,,,"]
    lines = table(spark, d, "nation").select(F.col("n_nationkey").alias("o"), F.concat_ws(",", F.when(F.col("n_nationkey") % 4 == 0, "False").otherwise("True"), F.lit("IP Address"), "n_name", F.concat(F.lit('"'), F.lit("a, "), "n_name", F.lit('"')), F.col("n_regionkey").cast("string")).alias("value"))
    first = spark.createDataFrame(list(enumerate(head, -3)), "o int, value string")
    first.unionByName(lines).coalesce(1).sortWithinPartitions("o").select("value").write.text(path)
    return tables.read_export(spark, path)


@query("SELECT n_name AS rid, 'a, ' || n_name AS q1, CAST(row_number() OVER (ORDER BY n_nationkey) - 1 AS BIGINT) AS ord FROM nation")
def s06_export_scan(spark, d):
    return _export(spark, d)[0].select("rid", F.col("Q1").alias("q1"), "ord")


@query("SELECT 'Why, then?' AS q1, 'Where' AS q2")
def s07_question_texts(spark, d):
    texts = _export(spark, d)[1]
    return spark.createDataFrame([(texts["Q1"], texts["Q2"])], "q1 string, q2 string")


@query("""SELECT n_name AS participant_id, '<question>Why, then?</question>' || chr(10) || '<response>a, ' || n_name || '</response>' || chr(10) || chr(10) || '<question>Where</question>' || chr(10) || '<response>' || n_regionkey || '</response>' AS survey_text,
    'Response 1: a, ' || n_name || chr(10) || chr(10) || 'Response 2: ' || n_regionkey AS response_text FROM nation WHERE n_nationkey % 4 > 0""")
def r08_round_1_texts(spark, d):
    df, texts = _export(spark, d)
    rows = intake.finished(intake.with_respondent_ids(df))
    return intake.round_1_texts(rows, texts, intake.interleaved(["Q1"], ["Q2"])).select("participant_id", "survey_text", "response_text")


@query("SELECT n_name AS participant_id, 'GOV Response:' || chr(10) || 'a, ' || n_name AS response_text, 'Why, then?' AS question_1, n_regionkey AS ranking_1_a_1 FROM nation")
def r10_round_2_columns(spark, d):
    df, texts = _export(spark, d)
    named = intake.renamed(df, {"rid": "participant_id", "Q1": "question_1", "Q2": "ranking_1_q_1"})
    return intake.round_2_columns(named, {"question_1": texts["Q1"], "ranking_1_q_1": texts["Q2"]}, ["question_1"], ["ranking_1_q_1"], []).select("participant_id", "response_text", "question_1", "ranking_1_a_1")


@query(NATION)
def s08_run_tables(spark, d):
    root = work_dir(spark)
    tables.write_table(table(spark, d, "nation"), root, "nation")
    return tables.read_table(spark, root, "nation")


@query(NATION)
def s10_json_documents(spark, d):
    path = work_dir(spark)
    sinks.json_document(table(spark, d, "nation")).write.text(path)
    return tables.read_json(spark, path, "n_nationkey int, n_name string, n_regionkey int")


@query("SELECT count(*) AS n FROM (SELECT * FROM nation LIMIT 7)")
def k06_results_with_a_head(spark, d):
    path = work_dir(spark)
    sinks.write_result(table(spark, d, "nation"), path, "jsonl", 7)
    return spark.read.json(path).agg(F.count("*").alias("n"))


@query("SELECT topic AS metric, round(avg(ord % 5), 6) AS mean, count(*) AS n FROM pq GROUP BY topic", "pq")
def k09_summary_and_rows(spark, d):
    path = work_dir(spark)
    sinks.summary_and_rows(pq(spark, d).select(F.col("topic").alias("metric"), (F.col("ord") % 5).cast("string").alias("score")), path)
    back = tables.read_csv(spark, f"{path}/summary", infer=True)
    return back.select("metric", F.round("mean", 6).alias("mean"), F.col("n").cast("bigint").alias("n"))


@query("SELECT n_nationkey AS id, n_name AS name FROM nation")
def p03_renamed(spark, d):
    return intake.renamed(table(spark, d, "nation"), {"n_nationkey": "id", "n_name": "name"}).select("id", "name")


@query("SELECT 'quote' AS r1, 'question_2' AS r2")
def p08_first_missing(spark, d):
    rows = pq(spark, d).drop("quote")
    return spark.createDataFrame([(intake.first_missing(rows, intake.round_1_required()), intake.first_missing(rows, intake.round_2_required()))], "r1 string, r2 string")


@query("SELECT ord, topic FROM pq", "pq")
def p09_required_fields(spark, d):
    return intake.required_fields(pq(spark, d), ["topic", "opinion"]).select("ord", "topic")


@query("SELECT 1 AS a, 2 AS a_1, 3 AS b, 4 AS a_2")
def p12_repeated_headers(spark, d):
    return spark.range(1).select(F.lit(1), F.lit(2), F.lit(3), F.lit(4)).toDF(*tables.deduplicated_names(["a", "a", "b", "a"]))


@query("SELECT c_custkey, n_name, r_name FROM customer FULL JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def j01_full_outer(spark, d):
    c = table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("k"))
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("k"), "n_name", F.col("n_regionkey").alias("r_regionkey"))
    return basics.full_outer(c, n, "k").join(table(spark, d, "region"), "r_regionkey", "left").select("c_custkey", "n_name", "r_name")


@query("SELECT coalesce(a.k, b.k) AS k, a.v AS v_r1, b.v AS v_r2 FROM (SELECT n_nationkey AS k, n_name AS v FROM nation WHERE n_nationkey < 15) a FULL JOIN (SELECT n_nationkey AS k, n_name AS v FROM nation WHERE n_nationkey > 10) b ON a.k = b.k")
def j03_suffixes(spark, d):
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("v"))
    return basics.full_outer(n.where("k < 15"), n.where("k > 10"), "k", ("_r1", "_r2"))


@query("+n AS (SELECT count(DISTINCT participant_id) AS n FROM pm) SELECT proposition AS statement, round(sum(approved) / (SELECT n FROM n), 6) AS agree_rate FROM pm GROUP BY proposition", "pv", "pm")
def j07_statement_rates(spark, d):
    said = pv(spark, d).select(F.col("proposition").alias("statement")).distinct().withColumn("agree_rate", F.lit(9.0))
    return refinement.with_rates(said, pv(spark, d)).select("statement", F.round("agree_rate", 6).alias("agree_rate"))


@query("SELECT o_custkey AS participant_id, count(*) FILTER (o_orderpriority = '1-URGENT') > 3 AS answer_1_agrees FROM orders GROUP BY 1")
def j21_written_back(spark, d):
    wide = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("participant_id")).agg(F.count_if(F.col("o_orderpriority") == "1-URGENT").cast("string").alias("answer_1"))
    scores = wide.select("participant_id", F.lit(1).alias("n"), (F.col("answer_1").cast("int") > 3).alias("agrees"))
    return B.written_back(wide, scores).select("participant_id", "answer_1_agrees")


@query("SELECT c_custkey AS participant_id, 1 AS n, c_mktsegment AS topic, c_name AS answer FROM customer WHERE c_custkey % 3 > 0")
def r01_gallery(spark, d):
    c = table(spark, d, "customer")
    wide = c.select(F.col("c_custkey").alias("participant_id"), F.lit("q").alias("question_1"), F.col("c_mktsegment").alias("question_1_topic"), F.when(F.col("c_custkey") % 3 > 0, F.col("c_name")).alias("answer_1"))
    return B.gallery(wide).select("participant_id", "n", "topic", "answer")


@query("SELECT c_custkey AS participant_id, 'Topic' AS topic, CASE WHEN c_custkey % 2 = 0 THEN 'B>A' ELSE 'A>B' END AS ranking FROM customer")
def r02_ballots_with_topic_columns(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("participant_id"))
    wide = c.withColumns({"ranking_7_topic": F.lit("Topic"), "ranking_7_q_1": F.lit("A"), "ranking_7_a_1": (2 - F.col("participant_id") % 2).cast("string"), "ranking_7_q_2": F.lit("B"), "ranking_7_a_2": (1 + F.col("participant_id") % 2).cast("string"), "ranking_7_q_c": F.lit("why"), "ranking_7_a_c": F.lit("so")})
    return B.ballots(wide).select("participant_id", "topic", F.array_join("ranking", ">").alias("ranking"))


@query("SELECT o_custkey AS participant_id, 'T' AS topic, arg_min(o_orderpriority, o_orderkey) AS ranking FROM orders GROUP BY 1")
def r06_ballots_of_first_rows(spark, d):
    rows = table(spark, d, "orders").select(F.col("o_custkey").alias("participant_id"), F.col("o_orderkey").alias("ord"), F.concat(F.lit("Topic: \nT - "), "o_orderpriority").alias("ranking_1_q_1"), F.lit("1").alias("ranking_1_a_1"))
    return B.ballots_of_rows(rows, least=2).select("participant_id", "topic", F.array_join("ranking", ">").alias("ranking"))


def _nested(spark, d):
    """Statements with one quote on one topic and two opinions."""
    topic = F.struct(F.col("topic").alias("name"), F.array(F.struct(F.col("opinion").alias("name")), F.struct(F.lit("Z").alias("name"))).alias("subtopics"))
    quote = F.struct(statements.quote_id(F.col("ord"), F.col("topic")).alias("id"), F.concat(F.lit("["), "quote", F.lit("]")).alias("text"), topic.alias("topic"))
    return pq(spark, d).select(F.col("ord").alias("id"), "quote", F.array(quote).alias("quotes"))


@query("SELECT ord AS id, ord || '-' || topic AS quote_id, topic, replace(replace(quote, '[', ''), ']', '') AS quote FROM pq", "pq")
def r11_rows_per_quote(spark, d):
    return statements.per_quote(_nested(spark, d)).select("id", "quote_id", "topic", "quote")


@query("SELECT ord AS id, topic, unnest([opinion, 'Z']) AS opinion FROM pq", "pq")
def r12_rows_per_opinion(spark, d):
    return statements.per_opinion(_nested(spark, d)).select("id", "topic", "opinion")


@query("SELECT ord, topic, opinion AS input_topic FROM pq", "pq")
def r18_flattened_metadata(spark, d):
    return evals.flattened(pq(spark, d).select("ord", "topic", F.struct(F.col("opinion").alias("topic")).alias("metadata")))


@query("SELECT ord, CASE WHEN ord % 3 = 0 THEN '' ELSE 'GOV Response:' || chr(10) || topic END AS response_text FROM pq", "pq")
def r26_labelled_responses(spark, d):
    rows = pq(spark, d).select("ord", F.when(F.col("ord") % 3 == 0, F.col("ord").cast("string")).otherwise(F.col("topic")).alias("q"))
    return rows.select("ord", intake.labelled_responses({"GOV Response": ["q"]}).alias("response_text"))


@query("SELECT ord, CASE WHEN ord % 2 = 0 THEN topic END AS answer FROM pq", "pq")
def r27_intro_questions(spark, d):
    rows = pq(spark, d).select("ord", F.lit("q").alias("question_1"), F.when(F.col("ord") % 2 == 0, F.col("topic")).alias("answer_1"))
    return intake.typed_intro(rows).select("ord", "intro.answer")


@query("SELECT ord, topic AS about, quote AS answer FROM pq WHERE quote IS NOT NULL AND trim(quote) <> ''", "pq")
def r19_agreement_questions(spark, d):
    wide = pq(spark, d).select("ord", F.col("ord").alias("participant_id"), F.lit("q").alias("question_3"), F.col("topic").alias("question_3_topic"), F.col("quote").alias("answer_3"))
    return B.agreement_questions(wide).select(F.col("participant_id").alias("ord"), "about", "answer")


@query("SELECT doc_id, split_part(text, chr(10), 1) AS first FROM documents")
def f01_first_lines(spark, d):
    return table(spark, d, "documents").select("doc_id", T.first_line(F.col("text")).alias("first"))


@query("SELECT ord, CASE WHEN ord % 2 = 0 THEN 'id' || ord END AS sheet, CAST(ord AS VARCHAR) AS gid FROM pq", "pq")
def f32_sheet_urls(spark, d):
    url = F.concat(F.when(F.col("ord") % 2 == 0, F.concat(F.lit("https://x/d/id"), F.col("ord").cast("string"), F.lit("/edit"))).otherwise("https://x/"), F.lit("#gid="), F.col("ord").cast("string"))
    return pq(spark, d).select("ord", T.sheet_id(url).alias("sheet"), T.sheet_gid(url).alias("gid"))


@query("SELECT ord, topic AS name FROM pq", "pq")
def f21_tolerant_replies(spark, d):
    reply = F.concat(F.lit('Here you are:\n```json\n{"name": "'), "topic", F.lit('", "more": [1]}\n```'))
    return pq(spark, d).select("ord", codecs.parse_reply(reply, "name STRING")["name"].alias("name"))


@query("SELECT ord, topic AS a, opinion AS b FROM pq WHERE topic <> opinion", "pq")
def f26_lettered_statements(spark, d):
    letters = codecs.lettered(F.array("topic", "opinion"))
    return pq(spark, d).where("topic <> opinion").select("ord", letters["A"].alias("a"), letters["B"].alias("b"))


@query("SELECT ord, CASE WHEN topic = 'en' THEN '50%' ELSE '63%' END AS shown FROM pq", "pq")
def f17_locale_percents(spark, d):
    return pq(spark, d).select("ord", T.locale_percent(F.when(F.col("topic") == "en", 0.5).otherwise(63.0)).alias("shown"))


@query("+c AS (SELECT proposition, count(DISTINCT participant_id) AS n FROM pm WHERE approved = 1 GROUP BY 1) SELECT proposition, CAST(coalesce(n, 0) AS DOUBLE) AS score FROM c", "pv", "pm")
def g06_first_scores(spark, d):
    whole = social_choice.approval_means(pv(spark, d)).where("approved = 1").withColumn("approved", F.lit(True))
    return social_choice.pav_scores(social_choice._profiles(whole), []).select("proposition", F.round("score", 6).alias("score"))


@query("SELECT topic, count(*) > 30 AS asked FROM (SELECT DISTINCT topic, opinion FROM pq) GROUP BY topic", "pq")
def b07_settled_without_a_model(spark, d):
    counts = pq(spark, d).select("topic", "opinion").distinct().groupBy("topic").agg(F.count("*").alias("n"))
    asked, settled = batching.needs_model(counts, "n", 30)
    return asked.select("topic", F.lit(True).alias("asked")).unionAll(settled.select("topic", F.lit(False)))


@query("SELECT CAST(ord AS VARCHAR) AS id, CASE WHEN ord % 3 = 0 THEN 'again' WHEN topic = 'en' THEN 'English' ELSE 'Rest' END AS outcome FROM pq", "pq")
def v03_checked_records(spark, d):
    sent = pq(spark, d).select(F.col("ord").cast("string").alias("id"), "topic", "ord")
    records = sent.where("ord % 3 > 0").select("id", F.array(F.when(F.col("topic") == "en", " english").otherwise("Rest")).alias("topics"))
    wrong = sent.where("ord % 6 = 0").select("id", F.array(F.lit("none of these")).alias("topics"))
    good, again = statements.checked_records(records.unionAll(wrong), sent, ["English", "Rest"])
    return good.select("id", F.element_at("topics", 1).alias("outcome")).unionAll(again.select("id", F.lit("again")))


@query("SELECT ord, topic <> 'en' AS valid FROM pq", "pq")
def v13_valid_topics(spark, d):
    rows = pq(spark, d).select("ord", F.array(F.struct(F.col("topic").alias("name")), F.struct(F.lit("en").alias("name"))).alias("topics"))
    return evals.valid_topics(rows).select("ord", "valid")


@query("SELECT ord, CASE WHEN ord % 5 > 3 THEN true WHEN ord % 5 < 2 THEN false END AS agrees FROM pq", "pq")
def v09_agreement_of_scores(spark, d):
    rows = pq(spark, d).select(F.col("ord").alias("participant_id"), F.lit(1).alias("n"), (F.col("ord") % 5).alias("score"))
    return evals.agreement_of_scores(rows).select(F.col("participant_id").alias("ord"), "agrees")


@query("SELECT 0 AS no_question, 0 AS no_topic, 0 AS tied_ranks, c_custkey AS participant_id FROM customer")
def v12_pool_problems(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("participant_id"))
    g = c.select("participant_id", F.lit("q").alias("question"), F.lit("t").alias("topic"))
    r = c.select("participant_id", F.lit(1).alias("set_no"), F.lit(1.0).alias("rank"))
    return evals.pool_problems(g, r).select(F.col("no_question").cast("int"), F.col("no_topic").cast("int"), F.col("tied_ranks").cast("int"), "participant_id")


@query("SELECT 's' AS stage, count(*) AS jobs, count(*) FILTER (event_id % 5 > 0) AS ok, CAST(sum(event_id % 3) AS BIGINT) AS calls FROM events")
def a28_stage_summary(spark, d):
    e = table(spark, d, "events")
    ledger = e.select(F.lit("s").alias("stage"), F.when(F.col("event_id") % 5 == 0, "error").otherwise("ok").alias("status"), (F.col("event_id") % 3).alias("attempts"), F.lit(1).alias("tokens_in"), F.lit(1).alias("tokens_out"), F.lit(0.5).alias("seconds"))
    return inference.stage_summary(ledger).select("stage", "jobs", "ok", "calls")


@query("SELECT DISTINCT topic AS text, 'canned ' || topic AS response FROM pq", "pq")
def m01_inference(spark, d):
    topics = [r[0] for r in pq(spark, d).select("topic").distinct().collect()]
    infer = inference.Inference(spark, inference.Canned({t: f"canned {t}" for t in topics}), partitions=2)
    return infer(pq(spark, d).select(F.col("topic").alias("prompt")), "m01").select(F.col("prompt").alias("text"), "response").distinct()


@query("SELECT 3 AS rows, 1 AS stages")
def l02_stages(spark, d):
    run = lifecycle.Run(spark, work_dir(spark))
    for _ in range(2):
        out = run.stage("numbers", lambda: spark.range(3))
    return spark.createDataFrame([(out.count(), run.manifest().count())], "rows int, stages int")


@query("SELECT true AS before, false AS after")
def l04_selected_yet(spark, d):
    rows = pq(spark, d).withColumn("selected", F.col("ord") == 0)
    return spark.createDataFrame([(dedup.has_selected(rows), dedup.has_selected(rows.where("NOT selected")))], "before boolean, after boolean")


@query("SELECT 'pav' AS a, 'schulze' AS b")
def l05_ranking_column(spark, d):
    names = [dedup.ranking_column(x) for x in (["full_schulze_ranking", "full_pav_ranking"], ["full_schulze_ranking"])]
    return spark.createDataFrame([tuple(n.split("_")[1] for n in names)], "a string, b string")


@query("SELECT 'Combine.' || chr(10) || chr(10) || string_agg('## ' || topic || chr(10) || p, chr(10) || chr(10) ORDER BY topic) AS prompt FROM (SELECT topic, string_agg('- ' || opinion, chr(10) ORDER BY opinion) AS p FROM (SELECT DISTINCT topic, opinion FROM pq) GROUP BY topic)", "pq")
def l06_selected_prompt(spark, d):
    rows = pq(spark, d).select("topic", F.col("opinion").alias("proposition")).distinct().withColumn("selected", F.lit(True)).withColumn("rank", F.col("proposition"))
    return lifecycle.selected_prompt(rows, "Combine.")


@query("SELECT label, value, row_number() OVER (PARTITION BY label ORDER BY value) AS place FROM (SELECT DISTINCT label, value FROM pdl)", "pd", "pdl")
def o06_values_in_order(spark, d):
    from pyspark.sql import Window

    values = report.demographics(intake.unpivoted_demographics(pd(spark, d)), most=1000)
    return values.select("label", "value", F.row_number().over(Window.partitionBy("label").orderBy(F.col("value") == "Other", "value")).cast("bigint").alias("place"))


@query("SELECT topic, count(DISTINCT participant_id) AS people, row_number() OVER (ORDER BY count(DISTINCT participant_id) DESC, topic) AS place FROM pq WHERE trim(quote) <> '' GROUP BY topic", "pq")
def o04_topics_by_people(spark, d):
    from pyspark.sql import Window

    counts = pq(spark, d).where("trim(quote) <> ''").groupBy("topic").agg(F.countDistinct("participant_id").alias("people"))
    return counts.withColumn("place", F.row_number().over(Window.orderBy(F.desc("people"), "topic")).cast("bigint"))
