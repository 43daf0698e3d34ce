"""Queries: model steps with a provider whose replies follow from the prompt's digest, so that SQL can repeat them."""

from __future__ import annotations

import hashlib
import html
import json
import re

from pyspark.sql import functions as F

from ..operators import dedup, evals, pipelines, refinement
from ..operators.inference import Canned, Inference, digest_score
from ..operators.lifecycle import Run
from ..session import table, work_dir
from .choice import _draft_rows, _schulze_sql
from .registry import pb, pd, pq, pv, query

SCORE = "(concat('0x', substr(md5({p}), 1, 8))::UBIGINT / 4294967296.0 * 4)"


def _scored(spark) -> Inference:
    return Inference(spark, Canned(otherwise=digest_score), partitions=4)


def _item(c: str) -> str:
    return f"'<item>' || replace(replace(replace({c}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || '</item>'"


ASKED = "'How much of the attribute {a} has this text? JSON {{score}} from 0 to 1.' || chr(10) || " + _item("quote").replace("{", "{{").replace("}", "}}")


@query("SELECT ord AS row_id, " + ", ".join(f"round({SCORE.format(p=ASKED.format(a=a))}, 9) AS {a}" for a in ("toxicity", "respect")) + " FROM pq", "pq")
def m18_content_scores(spark, d):
    rows = pq(spark, d).select(F.col("ord").alias("row_id"), F.col("quote").alias("text"))
    scores = pipelines.content_scores(_scored(spark), rows, ["toxicity", "respect"])
    return scores.select("row_id", *(F.round(a, 9).alias(a) for a in ("toxicity", "respect")))


RUBRIC = "\n".join(f"{k}: {v}" for k, v in evals.RUBRIC.items())
JUDGED = (
    f"'Criteria: {evals.METRICS['opinion_quality'].criteria}' || chr(10) || 'Scores:' || chr(10) || '" + "' || chr(10) || '".join(RUBRIC.split("\n")) + "' || chr(10) || '<topic>' || topic || '</topic>' || chr(10) || '<answer>' || opinion || '</answer>' || chr(10) || "
    """'Reply with {"score": number, "explanation": text}.'"""
)


@query("SELECT DISTINCT topic, opinion, round(" + SCORE.replace("{p}", JUDGED) + ", 9) AS score FROM pq", "pq")
def m31_evaluated_opinions(spark, d):
    rows = pq(spark, d).select("topic", F.col("opinion").alias("response")).distinct()
    scored = pipelines.evaluated(_scored(spark), rows, evals.METRICS["opinion_quality"])
    return scored.select("topic", F.col("response").alias("opinion"), F.round("score", 9).alias("score"))


def _votes(prompt: str) -> str:
    """Agrees with the statements whose digest with the person's record is even."""
    record = prompt.split("\n")[1]
    listed = re.findall(r"^([A-Z])\. (.*)$", prompt, re.M)
    vote = lambda s: "Agree" if int(hashlib.md5(f"{record}{s}".encode()).hexdigest()[:8], 16) % 2 == 0 else "Disagree"
    return json.dumps({"reasoning": "", "votes": [{"statement_letter": a, "vote": vote(s)} for a, s in listed]})


@query(
    """SELECT participant_id, p AS proposition, (concat('0x', substr(md5('customer ' || participant_id || p), 1, 8))::UBIGINT % 2) = 0 AS approved
FROM pd, (SELECT unnest(['more parks', 'less noise', 'new bridges']) AS p)""",
    "pd",
)
def m24_simulated_jury(spark, d):
    people = pd(spark, d).select("participant_id", F.concat(F.lit("customer "), F.col("participant_id").cast("string")).alias("record"))
    infer = Inference(spark, Canned(otherwise=_votes), partitions=4)
    return pipelines.jury(infer, people, ["more parks", "less noise", "new bridges"], batch=2)


@query(
    """SELECT topic, opinion, string_agg(p, '|' ORDER BY n) AS propositions FROM (SELECT DISTINCT topic, opinion FROM pq), (SELECT unnest(['one', 'two']) AS p, unnest([1, 2]) AS n) GROUP BY topic, opinion""",
    "pq",
)
def m27_generated_propositions(spark, d):
    by_opinion = pq(spark, d).groupBy("topic", "opinion").agg(F.array_sort(F.collect_set("quote")).alias("quotes"))
    made = pipelines.generated_propositions(Inference(spark, Canned(otherwise=_two), partitions=4), by_opinion, 2, keep_original=False)
    return made.select("topic", "opinion", F.array_join("propositions", "|").alias("propositions"))


def _two(prompt: str) -> str:
    return 'Sure: ["one", "two"]'


@query("SELECT DISTINCT topic || '-' || opinion AS id, 'part of ' || opinion AS quote FROM pq", "pq")
def m16_extracted_quotes(spark, d):
    rows = pq(spark, d).select(F.col("topic").alias("id"), F.col("opinion").alias("topic"), F.col("opinion").alias("text")).distinct()
    out = pipelines.extracted_quotes(Inference(spark, Canned(otherwise=_part), partitions=4), rows)
    return out.select(F.col("quote_id").alias("id"), "quote")


def _part(prompt: str) -> str:
    return "[part] of " + re.search(r"<item>(.*)</item>", prompt)[1]


@query("SELECT topic, 'S' || length(topic) AS summary FROM (SELECT DISTINCT topic FROM pq)", "pq")
def m29_topic_summaries(spark, d):
    infer = Inference(spark, Canned(otherwise=lambda p: "S"), partitions=4)
    _, topics, _ = pipelines.report_texts(infer, pq(spark, d))
    return topics.select("topic", F.concat("summary", F.length("topic").cast("string")).alias("summary"))


# --- learning and assigning topics and opinions ------------------------------------------------------------------------


def _listed(prompt: str) -> list[str]:
    return re.findall(r"^- (.*)$", prompt, re.M)


def _categoriser(prompt: str) -> str:
    """Replies of all steps of a categorisation, each a function of what the prompt holds, so that SQL can repeat them.

    A text is of the topic T0 to T3 by its length, and of the opinion O0 to O2 by the length's third; what the first attempt
    leaves out the next ones give, but for every tenth text; a judge accepts the opinion that the length says.
    """
    items = [html.unescape(x) for x in re.findall(r"<item>(.*?)</item>", prompt, re.S)]
    attempt = int((re.search(r"Attempt (\d+)", prompt) or [0, 0])[1])
    name = lambda prefix, n: {"name": f"{prefix}{n}"}
    if prompt.startswith("Name the topics"):
        return json.dumps({"topics": [name("T", len(x) % 4) for x in items]})
    if prompt.startswith("Merge these topics"):
        return json.dumps({"topics": [{"name": x} for x in _listed(prompt)]})
    if prompt.startswith("Assign topics"):
        rows = [json.loads(line) for line in prompt.split("\n")[1:]]
        kept = [r for r in rows if int(r["id"]) % 10 != 3 and (attempt > 1 or int(r["id"]) % 2 == 0)]
        return json.dumps({"items": [{"id": r["id"], "topics": [name("T", len(r["text"]) % 4)]} for r in kept]})
    if prompt.startswith("Name the opinions"):
        return json.dumps({"name": re.search(r"opinions on (\S+)", prompt)[1], "subtopics": [name("O", len(x) // 3 % 3) for x in items]})
    if prompt.startswith("Merge these opinions"):
        return json.dumps({"name": re.search(r"opinions on (\S+),", prompt)[1], "subtopics": [{"name": x} for x in _listed(prompt)]})
    if prompt.startswith("Which of the opinions"):
        return json.dumps({"quote_id": re.search(r"^(\S+): ", prompt[prompt.index("\n") :], re.M)[1], "topics": [name("O", attempt - 1)]})
    if prompt.startswith("Copy from the text"):
        return items[0]
    if prompt.startswith("Criteria"):
        quote = re.search(r"<quote>(.*)</quote>", prompt, re.S)[1]
        return json.dumps({"score": 5 if re.search(r"<answer>O(\d)</answer>", prompt)[1] == str(len(quote) // 3 % 4) else 1, "explanation": ""})
    raise ValueError(prompt[:80])


def _categorising(spark) -> Inference:
    return Inference(spark, Canned(otherwise=_categoriser), partitions=4)


SHORT = "short AS (SELECT doc_id, regexp_replace(text, '\\s+', ' ', 'g') AS text FROM documents)"


def _texts(spark, d):
    """All texts with single blanks, whole."""
    return table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.col("doc_id").alias("ord"), F.regexp_replace("text", r"\s+", " ").alias("text"))


@query(f"+{SHORT} SELECT DISTINCT 'T' || (length(text) % 4) AS topic FROM short")
def m12_learned_topics(spark, d):
    return pipelines.learned_topics(_categorising(spark), _texts(spark, d))


@query(f"+{SHORT}, o AS (SELECT doc_id % 5 AS t, text FROM short) SELECT DISTINCT 'S' || t AS topic, 'O' || (length(text) // 3 % 3) AS opinion FROM o UNION SELECT DISTINCT 'S' || t, 'Other' FROM o")
def m13_learned_opinions(spark, d):
    rows = _texts(spark, d).select(F.concat(F.lit("S"), (F.col("ord") % 5).cast("string")).alias("topic"), "ord", "text")
    return pipelines.learned_opinions(_categorising(spark), rows)


@query(f"+{SHORT} SELECT CAST(doc_id AS VARCHAR) AS id, CASE WHEN doc_id % 10 = 3 THEN 'Other' ELSE 'T' || (length(text) % 4) END AS topics FROM short")
def m14_categorised_topics(spark, d):
    found = pipelines.categorised_topics(_categorising(spark), _texts(spark, d), ["T0", "T1", "T2", "T3"])
    return found.select("id", F.array_join("topics", "|").alias("topics"))


@query(f"+{SHORT} SELECT doc_id || '-S' AS quote_id, CASE length(text) // 3 % 4 WHEN 3 THEN 'Other' ELSE 'O' || (length(text) // 3 % 4) END AS opinion FROM short")
def m15_categorised_opinions(spark, d):
    quotes = _texts(spark, d).select(F.concat(F.col("id").cast("string"), F.lit("-S")).alias("quote_id"), F.lit("S").alias("topic"), F.col("text").alias("quote"))
    opinions = spark.sql("SELECT 'S' AS topic, explode(array('O0', 'O1', 'O2', 'Other')) AS opinion")
    return pipelines.categorised_opinions(_categorising(spark), quotes, opinions).select("quote_id", "opinion")


@query(
    f"""+{SHORT}, t AS (SELECT doc_id, CASE WHEN doc_id % 10 = 3 THEN 'Other' ELSE 'T' || (length(text) % 4) END AS topic, trim(text) AS quote FROM short),
learned AS (SELECT DISTINCT topic, 'O' || (length(quote) // 3 % 3) AS opinion FROM t WHERE topic <> 'Other'),
a AS (SELECT *, 'O' || (length(quote) // 3 % 4) AS o FROM t)
SELECT CAST(doc_id AS VARCHAR) AS id, a.topic, coalesce(opinion, 'Other') AS opinion, quote FROM a LEFT JOIN learned ON a.topic = learned.topic AND a.o = learned.opinion"""
)
def l08_categorised_run(spark, d):
    found = pipelines.categorised(Run(spark, work_dir(spark)), _categorising(spark), _texts(spark, d))
    return found.select("id", "topic", "opinion", "quote")


@query(
    """SELECT scale, participant_id, p AS proposition, (concat('0x', substr(md5('customer ' || participant_id || p), 1, 8))::UBIGINT % n) < yes AS approved
FROM pd, (SELECT unnest(['more parks', 'less noise']) AS p), (VALUES ('AGREE_DISAGREE', 2, 1), ('AGREE_NEUTRAL_DISAGREE', 3, 1), ('FOUR_POINTS', 4, 2), ('FIVE_POINTS', 5, 2), ('APPROVE_DISAPPROVE', 2, 1), ('YES_NO', 2, 1)) AS s(scale, n, yes)""",
    "pd",
)
def m25_vote_scales(spark, d):
    """A jury by each of the scales: the answer of that number is taken."""

    def votes(prompt: str) -> str:
        scale, record = re.search(r"one of (.*): JSON", prompt)[1].split(", "), prompt.split("\n")[1]
        pick = lambda s: scale[int(hashlib.md5(f"{record}{s}".encode()).hexdigest()[:8], 16) % len(scale)]
        return json.dumps({"reasoning": "", "votes": [{"statement_letter": a, "vote": pick(s)} for a, s in re.findall(r"^([A-Z])\. (.*)$", prompt, re.M)]})

    people = pd(spark, d).select("participant_id", F.concat(F.lit("customer "), F.col("participant_id").cast("string")).alias("record"))
    infer = Inference(spark, Canned(otherwise=votes), partitions=4)
    out = [pipelines.jury(infer, people, ["more parks", "less noise"], scale=s).select(F.lit(s).alias("scale"), "participant_id", "proposition", "approved") for s in pipelines.SCALES]
    whole = out[0]
    for one in out[1:]:
        whole = whole.unionAll(one)
    return whole


@query(_schulze_sql("pb").replace(" SELECT candidate, wins, losses, rank, p AS strength FROM nexts LEFT JOIN paths ON nexts.i = paths.i AND nexts.nx = paths.j", " SELECT candidate AS proposition, rank AS schulze_rank FROM ranked"), "pb", recursive=True)
def m26_jury_ranks(spark, d):
    return pipelines.jury_report(pv(spark, d), pb(spark, d), []).select("proposition", "schulze_rank")


@query(
    """+m AS (SELECT participant_id, proposition, avg(CASE WHEN approved THEN 1.0 ELSE 0.0 END) AS a FROM pv GROUP BY ALL),
r AS (SELECT proposition, sum(a) / (SELECT count(DISTINCT participant_id) FROM m) AS rate FROM m GROUP BY proposition)
SELECT proposition, round(rate, 6) AS approval_rate, round(rate * 100 - length(proposition) * 10, 6) AS error FROM r""",
    "pv",
)
def m26_jury_error(spark, d):
    votes = pv(spark, d)
    truth = votes.select("proposition").distinct().select("proposition", F.concat((F.length("proposition") * 10).cast("string"), F.lit("%")).alias("rate"))
    report = pipelines.jury_report(votes, None, [], truth)
    return report.select("proposition", F.round("approval_rate", 6).alias("approval_rate"), F.round("error", 6).alias("error"))


@query(
    r"""+w AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents WHERE text IS NOT NULL),
g AS (SELECT doc_id, list_sort(list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' ')))) AS g FROM w WHERE len(w) > 0),
c AS (SELECT g, min('0:' || lpad(CAST(doc_id AS VARCHAR), 9, '0')) AS c FROM g GROUP BY g),
e AS (SELECT c, len(g) AS n, unnest(g) AS x FROM c),
l AS (SELECT a.c AS a, b.c AS b FROM e a JOIN e b ON a.x = b.x AND a.c < b.c GROUP BY a.c, b.c, a.n, b.n HAVING count(*) >= 0.75 * (a.n + b.n - count(*))),
m AS (SELECT a AS set_id, b AS c FROM l UNION ALL SELECT c, c FROM c),
d AS (SELECT set_id, list_sort(list('0:' || lpad(CAST(doc_id AS VARCHAR), 9, '0'))) AS members FROM m JOIN c ON m.c = c.c JOIN g ON g.g = c.g GROUP BY set_id)
SELECT set_id, array_to_string(members, '|') AS members FROM d WHERE len(members) > 1"""
)
def g14_similar_sets(spark, d):
    rows = table(spark, d, "documents").where("text IS NOT NULL").select(F.concat(F.lit("0:"), F.lpad(F.col("doc_id").cast("string"), 9, "0")).alias("proposition_id"), F.col("text").alias("proposition"))
    return dedup.similar_sets(rows).select("set_id", F.array_join("members", "|").alias("members"))


@query(
    """+t AS (SELECT topic, row_number() OVER (ORDER BY topic) - 1 AS topic_id FROM (SELECT DISTINCT topic FROM pos)),
n AS (SELECT proposition, list(topic ORDER BY topic) AS topics, arg_min(topic, p * 100 + topic_id) AS best FROM pos JOIN t USING (topic) GROUP BY proposition)
SELECT proposition AS set_id, CASE WHEN CAST(right(proposition, 1) AS INTEGER) % 2 = 0 THEN topics[len(topics)] ELSE best END AS winner FROM n WHERE len(topics) >= 2""",
    "sp",
)
def g18_judged_topics(spark, d):
    """The model names the last topic of every other set; where it names none, the best rank's topic holds."""

    def reply(prompt: str) -> str:
        lines = [x.split(": ") for x in prompt.split("\n")[1:]]
        return max(t for t, _ in lines) if int(lines[0][1][-1]) % 2 == 0 else "none of them"

    rows, sets = _draft_rows(spark, d)
    return refinement.judged_topics(Inference(spark, Canned(otherwise=reply), partitions=4), sets, rows)
