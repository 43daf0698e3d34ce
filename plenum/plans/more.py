"""Queries: sinks, sources, scalar functions, ids and tables of the refinement, over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import codecs
from ..functions import text as T
from ..operators import basics, batching, dedup, prompts, refinement, report, statements, world
from ..session import table
from ..sources import sinks, tables
from .registry import digest_share, digest_share_sql, pd, pq, pv, query, tagged


@query("SELECT participant_id, quote, topic, opinion, ord FROM pq", "pq")
def k01_ordered_columns(spark, d):
    return sinks.ordered_columns(pq(spark, d))


@query("SELECT topic, opinion FROM pq", "pq")
def k02_present_columns(spark, d):
    return sinks.present_columns(pq(spark, d), ["topic", "nope", "opinion"])


@query(
    """+o AS (SELECT DISTINCT topic, opinion FROM pq), p AS (SELECT topic, opinion, quote FROM pq WHERE opinion <> 'Other')
SELECT o.topic, o.opinion, coalesce(p.quote, 'No propositions found for this opinion.') AS proposition FROM o LEFT JOIN p USING (topic, opinion)""",
    "pq",
)
def k04_flat_propositions(spark, d):
    nested = pq(spark, d).groupBy("topic", "opinion").agg(F.collect_list(F.when(F.col("opinion") != "Other", F.struct(F.col("quote").alias("proposition")))).alias("propositions"))
    return sinks.flat_propositions(nested)


@query("SELECT ord, 'topic: ' || topic || chr(10) || 'opinion: ' || opinion AS card FROM pq", "pq")
def k07_cards(spark, d):
    return pq(spark, d).select("ord", sinks.card(["topic", "opinion"]).alias("card"))


@query("SELECT topic, '# ' || topic || chr(10) || chr(10) || string_agg('opinion: ' || opinion || chr(10) || 'ord: ' || ord, chr(10) || chr(10) ORDER BY ord) AS text FROM pq GROUP BY topic", "pq")
def k07_grouped_cards(spark, d):
    return sinks.grouped_cards(pq(spark, d).select("topic", "opinion", "ord"), "topic", ["ord"])


@query("SELECT ord, replace(quote, '<', '\\u003c') AS payload FROM pq", "pq")
def k11_inline_payloads(spark, d):
    return pq(spark, d).select("ord", sinks.inline_payload(F.col("quote")).alias("payload"))


@query("SELECT ord, '{\"topic\":\"' || topic || '\",\"opinion\":\"' || opinion || '\"}' AS value FROM pq", "pq")
def s11_rows_as_json(spark, d):
    return pq(spark, d).select("ord", F.to_json(F.struct("topic", "opinion"), {"ignoreNullFields": "false"}).alias("value"))


@query("SELECT ord, 'en;fr' AS topics FROM pq", "pq")
def s14_topics_argument(spark, d):
    return pq(spark, d).select("ord", F.array_join(tables.topics_argument(F.lit(" en, ,fr ")), ";").alias("topics"))


@query("SELECT c_custkey AS ord, row_number() OVER (ORDER BY c_custkey) AS n FROM customer")
def w05_numbered_rows(spark, d):
    return basics.numbered_rows(table(spark, d, "customer").select(F.col("c_custkey").alias("ord")), "n", chunk=100)


@query("SELECT topic, opinion, quote, ord, row_number() OVER (PARTITION BY topic ORDER BY ord) AS rank FROM pq QUALIFY rank <= 3", "pq")
def o08_top_per_topic(spark, d):
    return basics.top_per(pq(spark, d).drop("participant_id"), ["topic"], [F.col("ord")], 3).withColumn("rank", F.col("rank").cast("bigint"))


@query("SELECT ord, try_cast(CASE WHEN ord % 3 = 0 THEN 'x' ELSE ord::VARCHAR END AS DOUBLE) IS NOT NULL AS is_float FROM pq", "pq")
def f37_floats(spark, d):
    return pq(spark, d).select("ord", T.is_numeric(F.when(F.col("ord") % 3 == 0, "x").otherwise(F.col("ord").cast("string"))).alias("is_float"))


@query("SELECT ord, topic AS t, opinion AS o, quote AS q FROM pq WHERE position('”' IN quote) = 0 AND quote <> '' AND trim(quote) = quote", "pq")
def f02_topic_opinion_quote(spark, d):
    text = F.concat(F.lit("Topic: "), "topic", F.lit("\n\nOpinion: "), "opinion", F.lit("\n\n“"), "quote", F.lit("”\n\nHow would you respond to this quote?"))
    p = T.topic_opinion_quote(text)
    return pq(spark, d).where("instr(quote, '”') = 0 AND quote <> '' AND trim(quote) = quote").select("ord", p["topic"].alias("t"), p["opinion"].alias("o"), p["quote"].alias("q"))


@query("SELECT ord, topic AS topic, opinion AS statement FROM pq", "pq")
def f03_ranking_topics(spark, d):
    text = F.concat(F.lit("Topic: \n"), "topic", F.lit(" - "), "opinion")
    return pq(spark, d).select("ord", T.ranking_topic(text).alias("topic"), T.without_ranking_topic(text).alias("statement"))


@query("SELECT ord, quote || '|' || topic AS parts FROM pq WHERE position(':' IN quote) = 0", "pq")
def f07_labelled_parts(spark, d):
    text = F.concat(F.lit("A:\n"), "quote", F.lit("\n\nplain\n\nB:\n"), "topic")
    return pq(spark, d).where("instr(quote, ':') = 0").select("ord", F.array_join(T.labelled_parts(text), "|").alias("parts"))


@query("SELECT ord, quote AS plain FROM pq WHERE position('[' IN quote) = 0 AND position(']' IN quote) = 0", "pq")
def f08_without_brackets(spark, d):
    text = F.concat(F.lit("["), "quote", F.lit("]"))
    return pq(spark, d).where("instr(quote, '[') = 0 AND instr(quote, ']') = 0").select("ord", T.without_brackets(text).alias("plain"))


@query("SELECT ord, topic || '>' || opinion || '>' || 'x,y' AS tree FROM pq", "pq")
def f10_three_levels(spark, d):
    text = F.concat("topic", F.lit(":"), "opinion", F.lit(":x; "), "topic", F.lit(":"), "opinion", F.lit(":y;"))
    t = F.element_at(codecs.parse_topics_deep(text), 1)
    s = F.element_at(t["subtopics"], 1)
    return pq(spark, d).select("ord", F.concat_ws(">", t["name"], s["name"], F.array_join(F.transform(s["subtopics"], lambda x: x["name"]), ",")).alias("tree"))


@query("SELECT ord, 18.0::DOUBLE AS seconds, '1h 2m 3s' AS shown FROM pq", "pq")
def f33_durations(spark, d):
    return pq(spark, d).select("ord", T.seconds_of(F.lit("18s")).alias("seconds"), T.pretty_seconds(F.lit(3723.5)).alias("shown"))


@query("SELECT ord, replace(replace(topic, 'en', 'EN'), 'fr', 'FR') AS replaced FROM pq", "pq")
def f31_replaced_literals(spark, d):
    return pq(spark, d).select("ord", T.replaced_literals(F.col("topic"), [("en", "EN"), ("fr", "FR")]).alias("replaced"))


@query("SELECT ord, 'On ' || topic || ': ' || opinion AS filled FROM pq", "pq")
def f40_interpolated(spark, d):
    return pq(spark, d).select("ord", T.interpolated(F.lit("On {t}: {o}"), {"t": F.col("topic"), "o": F.col("opinion")}).alias("filled"))


@query("SELECT ord, '<strong>' || topic || '</strong> <em>' || opinion || '</em>' AS html, topic AS title FROM pq", "pq")
def f19_markdown(spark, d):
    return pq(spark, d).select("ord", T.clean_markdown(F.concat(F.lit("**"), "topic", F.lit("** *"), "opinion", F.lit("*"))).alias("html"), T.without_header(F.concat(F.lit("## "), "topic")).alias("title"))


@query("SELECT ord, 'a=' || topic || ',b=' || opinion AS propositions FROM pq", "pq")
def f25_propositions_of_replies(spark, d):
    reply = F.concat(F.lit('ok [{"statement": "a='), "topic", F.lit('", "reasoning": "r"}, {"statement": "b='), "opinion", F.lit('"}, {"statement": " "}]'))
    return pq(spark, d).select("ord", F.array_join(F.transform(codecs.parse_propositions(reply), lambda p: p["statement"]), ",").alias("propositions"))


@query("SELECT ord, (ord % 7) || ':' || (ord % 3) AS id FROM pq", "pq")
def f29_first_ids(spark, d):
    return pq(spark, d).select("ord", codecs.first_id(F.concat(F.lit("I choose "), (F.col("ord") % 7).cast("string"), F.lit(":"), (F.col("ord") % 3).cast("string"), F.lit(" not 9:9"))).alias("id"))


@query(
    """+d AS (SELECT topic, opinion, min(ord) AS o, count(*) AS c FROM pq GROUP BY ALL), r AS (SELECT topic, opinion, row_number() OVER (PARTITION BY topic ORDER BY o) AS k FROM d WHERE c > 1)
SELECT topic, string_agg(k || ': ' || opinion, chr(10) ORDER BY k) AS dictionary FROM r GROUP BY topic""",
    "pq",
)
def f27_repeated_texts(spark, d):
    grouped = pq(spark, d).groupBy("topic").agg(basics.ordered_list("opinion", "ord").alias("t")).withColumn("k", codecs.reusable(F.col("t"), letters=False))
    return grouped.select("topic", F.array_join(F.transform("k", lambda x: F.concat(x["key"], F.lit(": "), x["text"])), "\n").alias("dictionary"))


@query(
    r"""SELECT conv_id AS participant_id, conv_id || '-' || t AS quote_id, t AS topic,
    array_to_string(list_transform(list_filter(list_transform(regexp_extract_all(survey_text, '(?s)<response>(.*?)</response>', 1), lambda x: trim(x)), lambda x: x <> ''),
    lambda x: CASE WHEN regexp_matches(x, '[.?!]$') THEN x ELSE x || '.' END), ' ') AS quote FROM tagged, (SELECT unnest(['A', 'B']) AS t)""",
    "ps",
    "tagged",
)
def m17_whole_response_quotes(spark, d):
    rows = tagged(spark, d).select(F.col("conv_id").alias("participant_id"), "survey_text", F.lit("B:x;A").alias("topics"))
    return statements.whole_response_quotes(rows)


@query(
    """SELECT topic, opinion, string_agg('<participant id="' || participant_id || '">' || translate(replace(quote, '"', ''), chr(10), ' ') || '</participant>', chr(10) ORDER BY participant_id, ord) AS text FROM pq GROUP BY ALL""",
    "pq",
)
def m32_first_round_texts(spark, d):
    return prompts.first_round(pq(spark, d))


@query(
    """+a AS (SELECT topic, opinion, count(*) AS r1_length FROM pq GROUP BY ALL), b AS (SELECT opinion, count(*) AS r2_length FROM pq WHERE ord % 4 = 0 AND opinion <> 'src3' GROUP BY opinion)
SELECT topic, opinion, r1_length, coalesce(r2_length, 0) AS r2_length FROM a LEFT JOIN b USING (opinion)""",
    "pq",
)
def r16_by_opinion(spark, d):
    r1 = pq(spark, d)
    r2 = r1.where("ord % 4 = 0 AND opinion <> 'src3'").select("participant_id", "opinion", F.col("quote").alias("question"), F.col("topic").alias("answer"), F.col("ord").alias("n"))
    return refinement.by_opinion(r1, r2).select("topic", "opinion", "r1_length", "r2_length")


@query("SELECT topic, opinion, quote AS proposition, row_number() OVER (PARTITION BY topic, opinion ORDER BY ord) - 1 AS idx FROM pq", "pq")
def r14_exploded_propositions(spark, d):
    nested = pq(spark, d).groupBy("topic", "opinion").agg(basics.ordered_list("quote", "ord").alias("propositions"))
    return refinement.exploded(nested).withColumn("idx", F.col("idx").cast("bigint"))


@query(
    """+m AS (SELECT participant_id, proposition, avg(CASE WHEN approved THEN 1.0 ELSE 0.0 END) AS a FROM pv GROUP BY ALL), n AS (SELECT count(DISTINCT participant_id) AS n FROM m),
r AS (SELECT proposition, sum(a) / (SELECT n FROM n) AS rate FROM m GROUP BY 1) SELECT t AS topic, 12 AS r1_quotes_by_topic, (SELECT round(sum(rate), 6) FROM r) AS total FROM (SELECT unnest(['A', 'B']) AS t)""",
    "pv",
)
def r17_enriched_topics(spark, d):
    from ..operators.social_choice import approval_rates

    rates = approval_rates(pv(spark, d))
    names = sorted(r[0] for r in rates.select("proposition").collect())
    opinions = spark.createDataFrame([(t, "o", 12, names) for t in "AB"], "topic string, opinion string, r1_length bigint, propositions array<string>")
    rows = refinement.enriched_topics(opinions, rates)
    return rows.select("topic", F.col("r1_quotes_by_topic").cast("int").alias("r1_quotes_by_topic"), F.round(F.aggregate("propositions", F.lit(0.0), lambda a, p: a + p["approval_rate"]), 6).alias("total"))


@query("SELECT ord, participant_id FROM pq WHERE participant_id IN (SELECT participant_id FROM pq WHERE ord % 97 = 0)", "pq")
def j15_skipped_rows(spark, d):
    rows = pq(spark, d).select("ord", "participant_id")
    return refinement.skipped_rows(rows, rows.where("ord % 97 = 0"))


@query(f"SELECT ord, topic, round({digest_share_sql('quote')}, 9) AS score FROM pq", "pq")
def j08_scores_by_row(spark, d):
    rows = pq(spark, d).select("ord", "topic")
    return refinement.with_scores(rows, pq(spark, d).select("ord", F.round(digest_share("quote"), 9).alias("score")), "ord")


@query(
    """+t AS (SELECT topic, count(*) AS q, row_number() OVER (ORDER BY count(*) DESC, topic) - 1 AS topic_id FROM pq GROUP BY topic),
o AS (SELECT topic, opinion, row_number() OVER (PARTITION BY topic ORDER BY opinion) - 1 AS idx FROM (SELECT DISTINCT topic, opinion FROM pq))
SELECT topic, opinion AS proposition, topic_id || ':' || idx AS proposition_id FROM o JOIN t USING (topic)""",
    "pq",
)
def g13_proposition_ids(spark, d):
    rows = pq(spark, d)
    sizes = rows.groupBy("topic").agg(F.count("*").alias("r1_quotes"))
    listed = rows.groupBy("topic").agg(F.array_sort(F.collect_set("opinion")).alias("o")).select("topic", F.posexplode("o").alias("idx", "proposition")).join(sizes, "topic")
    return dedup.with_ids(listed).select("topic", "proposition", "proposition_id")


@query(
    """+j AS (SELECT event_type AS topic, CASE WHEN event_id % 5 = 0 THEN 'error' ELSE 'ok' END AS status, value, event_type || event_id AS prompt, event_id % 7 AS tokens FROM events)
SELECT topic, count(*) AS jobs, count(*) FILTER (status <> 'ok') AS failed, round(100.0 * count(*) FILTER (status <> 'ok') / count(*), 6) AS failed_percent, round(avg(value), 6) AS seconds_a_job,
    CAST(sum(length(prompt)) AS BIGINT) AS characters, CAST(sum(tokens) AS BIGINT) AS tokens FROM j GROUP BY topic"""
)
def a09_run_statistics(spark, d):
    jobs = table(spark, d, "events").select(F.col("event_type").alias("topic"), F.when(F.col("event_id") % 5 == 0, "error").otherwise("ok").alias("status"), F.col("value").alias("seconds"), F.concat("event_type", F.col("event_id").cast("string")).alias("prompt"), (F.col("event_id") % 7).alias("tokens"))
    stats = world.run_statistics(jobs)
    return stats.withColumn("failed_percent", F.round("failed_percent", 6)).withColumn("seconds_a_job", F.round("seconds_a_job", 6))


@query("SELECT user_id AS participant_id, event_type AS topic, 'bad' AS error_message, event_id AS attempt_index FROM events WHERE event_id % 10 = 0")
def q07_failed_tries(spark, d):
    tries = F.when(F.col("event_id") % 10 == 0, F.array(F.struct(F.col("event_id").alias("attempt_index"), F.lit("bad").alias("error_message")))).otherwise(F.array().cast("array<struct<attempt_index:bigint,error_message:string>>"))
    rows = table(spark, d, "events").select(F.lit("topic").alias("level"), F.col("event_type").alias("topic"), F.col("user_id").alias("participant_id"), tries.alias("failed_tries"))
    return world.failed_tries(rows).drop("level")


@query("SELECT user_id AS participant_id, value FROM events")
def q06_simulation_results(spark, d):
    rows = table(spark, d, "events").select(F.col("event_type").alias("topic"), F.col("user_id").alias("participant_id"), "value")
    return world.simulation_results(rows, "combined")


@query("SELECT user_id AS participant_id, event_type AS topic FROM events")
def q12_nested_fields(spark, d):
    rows = table(spark, d, "events").select(F.struct(F.col("user_id").alias("participant_id"), F.struct(F.col("event_type").alias("topic")).alias("inner")).alias("a"))
    return rows.select("a.participant_id", "a.inner.topic")


@query("SELECT event_id % 3 AS failed_tries, count(*) AS count FROM events GROUP BY 1")
def a27_retry_histogram(spark, d):
    from ..operators.inference import retry_histogram

    ledger = table(spark, d, "events").select(F.slice(F.array(F.lit(1), F.lit(2)), F.lit(1), (F.col("event_id") % 3).cast("int")).alias("failed_tries"))
    return retry_histogram(ledger).withColumn("failed_tries", F.col("failed_tries").cast("bigint"))


@query(
    """+s AS (SELECT DISTINCT participant_id, segment FROM pd), a AS (SELECT participant_id, quote AS x, CAST(NULL AS VARCHAR) AS y FROM pq WHERE ord < 50), b AS (SELECT participant_id, CAST(NULL AS VARCHAR) AS x, segment AS y FROM s WHERE participant_id < 50)
SELECT * FROM a UNION ALL SELECT * FROM b""",
    "pq",
    "pd",
)
def u01_union_by_name(spark, d):
    a = pq(spark, d).where("ord < 50").select("participant_id", F.col("quote").alias("x"))
    b = pd(spark, d).where("participant_id < 50").select("participant_id", F.col("demo:Segment").alias("y"))
    return basics.unioned([a, b])


@query("SELECT topic, opinion, agree_rate FROM (SELECT topic, opinion, CAST(count(*) AS DOUBLE) AS agree_rate FROM pq GROUP BY ALL)", "pq")
def r25_predicted_agreement(spark, d):
    raw = pq(spark, d).groupBy(F.col("topic").alias("statement"), F.col("opinion").alias("group")).agg(F.count("*").cast("double").alias("agree_rate"))
    nested = report.predicted_agreement(raw).select("statement", F.explode("groups").alias("g"))
    return nested.select(F.col("statement").alias("topic"), F.col("g.group").alias("opinion"), F.col("g.agree_rate").alias("agree_rate"))


@query("SELECT topic, opinion, 'on ' || topic || opinion AS summary FROM (SELECT DISTINCT topic, opinion FROM pq)", "pq")
def p17_single_summaries(spark, d):
    rows = pq(spark, d).select("topic", "opinion").distinct()
    return report.single_summary(rows, rows.withColumn("summary", F.concat(F.lit("on "), "topic", "opinion")))


@query("SELECT ord // 2000 AS slab, ord FROM pq", "pq")
def b02_chunks(spark, d):
    rows = pq(spark, d).select("ord", F.col("quote").alias("text"))
    return batching.token_batches(rows, tokens=2_000, most=1_000_000, base=500).select("batch.slab", "ord")


@query("SELECT participant_id FROM pq WHERE participant_id IS NOT NULL AND (ord % 2 = 0 OR ord % 3 = 0)", "pq")
def p13_not_all_null(spark, d):
    rows = pq(spark, d).select("participant_id", F.when(F.col("ord") % 2 == 0, 1).alias("a"), F.when(F.col("ord") % 3 == 0, 1).alias("b"))
    return basics.drop_all_null(rows, ["a", "b"]).select("participant_id")
