"""The inference operator, its ledger, stages, and the model steps with canned replies."""

import asyncio
import json
import re
import sys

import pytest

from pyspark import cloudpickle

from plenum.operators import inference, lifecycle, pipelines
from plenum.operators.inference import Busy, Canned, Inference, Provider
from plenum.session import work_dir


# Executors have no module of this name: its functions go to them whole.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Scripted(Provider):
    """Replies by a list of what each call does; for runs on the driver."""

    def __init__(self, *script):
        self.script, self.asked = list(script), []

    def ask(self, prompt, system, schema, temperature):
        self.asked.append((prompt, temperature))
        step = self.script.pop(0) if self.script else "ok"
        if isinstance(step, Exception):
            raise step
        return step


def run(provider, prompts, valid=None, attempts=3):
    waits = []

    async def sleep(seconds):
        waits.append(seconds)

    jobs = [{"prompt": p, "temperature": 0.0} for p in prompts]
    return asyncio.run(inference._run(jobs, provider, valid, attempts, 1, sleep)), waits


def test_failed_tries_are_kept_and_warmer():
    p = Scripted(ValueError("broken"), "bad", "good")
    (r,), _ = run(p, ["x"], valid=lambda s: s == "good")
    assert (r["status"], r["response"], r["attempts"]) == ("ok", "good", 3)
    assert [(f["attempt_index"], f["error_message"], f["raw_response"]) for f in r["failed_tries"]] == [(0, "broken", None), (1, "the reply does not hold", "bad")]
    assert [t for _, t in p.asked] == [0.0, inference.WARMER, 2 * inference.WARMER]


def test_exhausted_jobs_stay_as_errors():
    (r,), _ = run(Scripted(*[ValueError("no")] * 3), ["x"])
    assert (r["status"], r["response"], r["error"], r["attempts"]) == ("error", None, "no", 3)


def test_a_busy_service_costs_no_try():
    (r,), waits = run(Scripted(Busy("429"), Busy("503", 18.0), "good"), ["x"], attempts=1)
    assert r["status"] == "ok" and r["attempts"] == 1 and waits == [2.0, 19.0]
    assert [inference.wait_after(n) for n in range(8)] == [2, 4, 8, 16, 32, 64, 64, 64]


def test_equal_prompts_are_asked_once_and_ledger_resumes(spark):
    jobs = spark.createDataFrame([(i, f"p{i % 3}") for i in range(9)], "job_id int, prompt string")
    ledger = work_dir(spark) + "/ledger"
    infer = Inference(spark, Canned(otherwise=inference.digest_score), ledger, partitions=2)
    rows = infer(jobs, "s", "score DOUBLE").orderBy("job_id").collect()
    assert len(rows) == 9 and all(0 <= r["parsed"]["score"] <= 4 for r in rows) and infer.done().count() == 3
    # The second run has all it needs: a provider that fails is not asked.
    again = Inference(spark, Canned(), ledger, partitions=2)
    assert [r["response"] for r in again(jobs, "s").orderBy("job_id").collect()] == [r["response"] for r in rows] and again.done().count() == 3
    assert {tuple(r) for r in inference.retry_histogram(again.done()).collect()} == {(0, 3)}
    assert inference.stage_summary(again.done()).first()["jobs"] == 3
    failing = Inference(spark, Canned(), attempts=1, partitions=1)
    assert {r["status"] for r in failing(jobs, "t").collect()} == {"error"}
    assert failing(jobs.limit(0), "t").count() == 0


def test_provider_of_chat_completions():
    p = inference.provider_by_name("chat_completions", url="http://localhost:1", model="m", style="json_object")
    body = p.body("hi", "sys", '{"type": "object"}', 0.5)
    assert body["messages"] == [{"role": "system", "content": "sys"}, {"role": "user", "content": "hi"}] and body["response_format"] == {"type": "json_object"}
    with pytest.raises(Exception):
        p.ask("hi", None, None, 0.0)


def test_retries_on_the_driver():
    values, waits = iter([1, 2, 3]), []
    assert inference.with_retries(lambda: next(values), lambda v: v == 3, 3, 1.0, waits.append) == 3 and waits == [1.0, 1.5]
    with pytest.raises(ValueError):
        inference.with_retries(lambda: 0, bool, 2, 0, lambda s: None)


def test_preview(spark):
    assert inference.preview(spark.createDataFrame([("a" * 50,), ("b",)], "prompt string"), 5, 3).orderBy("prompt").select("preview").collect()[0][0] == "aaaaa\n...\naaa"


def test_stages_resume(spark):
    root = work_dir(spark)
    calls = []

    def make():
        calls.append(1)
        return spark.range(3)

    first = lifecycle.Run(spark, root)
    assert first.stage("a", make).count() == 3 and first.stage("a", make).count() == 3
    assert lifecycle.Run(spark, root).stage("a", make).count() == 3 and len(calls) == 1
    # A table without its line in the manifest was cut off, and is written again.
    spark.range(1).write.parquet(f"{root}/b")
    assert not first.done("b") and first.stage("b", make).count() == 3
    assert first.manifest().count() == 2
    assert lifecycle.resolved_pool(None, None, lambda: spark.range(2)).count() == 2 and lifecycle.resolved_pool(spark.range(1), None, lambda: None).count() == 1


def replies(prompt):
    """A small model: topics, opinions, votes and judgements by what the prompt says."""
    if prompt.startswith(("Name the topics", "Merge these topics")):
        return json.dumps({"topics": [{"name": "Taxes"}, {"name": "Parks"}]})
    if prompt.startswith(("Name the opinions", "Merge these opinions")):
        topic = re.search(r"opinions on (\w+)", prompt)[1]
        return json.dumps({"name": topic, "subtopics": [{"name": f"more {topic}"}, {"name": f"less {topic}"}]})
    if prompt.startswith("Assign topics"):
        # The first time one line is left out, and another gets a label that is none.
        lines = [json.loads(x) for x in re.findall(r"^\{.*\}$", prompt, re.M)]
        first = "Attempt 1." in prompt
        return json.dumps({"items": [{"id": x["id"], "topics": [{"name": "taxes" if x["id"] != "2" else "nonsense" if first else "Parks"}]} for x in lines if not (first and x["id"] == "1") and x["id"] != "3"]})
    if prompt.startswith("Which of the opinions"):
        quote_id = re.search(r"^(\S+): ", prompt, re.M)[1]
        return json.dumps({"quote_id": quote_id, "topics": [{"name": "more Taxes"}]})
    if prompt.startswith("Criteria"):
        return json.dumps({"score": 4 if "good" in prompt else 1, "explanation": ""})
    if prompt.startswith("Copy from"):
        return "[The] quote"
    if prompt.startswith("Vote on"):
        n = len(re.findall(r"^[A-Z]\. ", prompt, re.M))
        return json.dumps({"votes": [{"statement_letter": "ABC"[i], "vote": "Agree" if i == 0 else "Disagree"} for i in range(n)]})
    if prompt.startswith("Rank the"):
        n = len(re.findall(r"^[A-Z]\. ", prompt, re.M))
        return json.dumps({"ranking": list("ABC"[:n])[::-1]})
    if prompt.startswith("Write"):
        return '["one", "two"]'
    if prompt.startswith("Combine"):
        return "1. first\n2. second"
    if prompt.startswith("How much"):
        return "no score" if "bad" in prompt else '{"score": 0.5}'
    return "summary"


@pytest.fixture
def infer(spark):
    return Inference(spark, Canned(otherwise=replies), partitions=2)


def test_topics_and_opinions(spark, infer):
    texts = spark.createDataFrame([(str(i), i, f"text {i}") for i in range(4)], "id string, ord bigint, text string")
    assert {r["topic"] for r in pipelines.learned_topics(infer, texts).collect()} == {"Taxes", "Parks"}
    topics = {r["id"]: r["topics"] for r in pipelines.categorised_topics(infer, texts, ["Taxes", "Parks"]).collect()}
    assert topics == {"0": ["Taxes"], "1": ["Taxes"], "2": ["Parks"], "3": ["Other"]}
    quotes = spark.createDataFrame([("Taxes", 0, "q"), ("Other", 1, "r")], "topic string, ord bigint, text string")
    assert {tuple(r) for r in pipelines.learned_opinions(infer, quotes).collect()} == {("Taxes", "more Taxes"), ("Taxes", "less Taxes"), ("Taxes", "Other"), ("Other", "Other")}
    opinions = spark.createDataFrame([("Taxes", "more Taxes"), ("Taxes", "Other")], "topic string, opinion string")
    asked = spark.createDataFrame([("a-Taxes", "Taxes", "good one"), ("b-Taxes", "Taxes", "poor one")], "quote_id string, topic string, quote string")
    assert {tuple(r) for r in pipelines.categorised_opinions(infer, asked, opinions, 2).collect()} == {("a-Taxes", "Taxes", "more Taxes"), ("b-Taxes", "Taxes", "Other")}


def test_quotes_scores_and_judgements(spark, infer):
    rows = spark.createDataFrame([("1", "t", "Taxes")], "id string, text string, topic string")
    assert pipelines.extracted_quotes(infer, rows).first().asDict() == {"quote_id": "1-Taxes", "id": "1", "topic": "Taxes", "quote_with_brackets": "[The] quote", "quote": "The quote"}
    texts = spark.createDataFrame([(1, "fine"), (2, "bad")], "row_id int, text string")
    assert {tuple(r) for r in pipelines.content_scores(infer, texts, ["toxic"]).collect()} == {(1, 0.5), (2, 0.0)}
    from plenum.operators import evals

    judged = spark.createDataFrame([("good", "x"), ("poor", "y")], "topic string, response string")
    assert {(r["topic"], r["score"]) for r in pipelines.evaluated(infer, judged, evals.METRICS["opinion_quality"]).collect()} == {("good", 4.0), ("poor", 1.0)}
    assert {r["score"] for r in pipelines.evaluated(Inference(spark, Canned(), attempts=1), judged, evals.METRICS["opinion_quality"]).collect()} == {2.0}


def test_jury(spark, infer):
    people = spark.createDataFrame([(1, "r1"), (2, "r2")], "participant_id int, record string")
    votes = pipelines.jury(infer, people, ["a", "b", "c"], batch=2)
    assert votes.count() == 6 and votes.where("approved").count() == 4
    ballots = pipelines.jury(infer, people, ["a", "b", "c"], "RANK")
    assert [len(r["ranking"]) for r in ballots.collect()] == [3, 3]
    truth = spark.createDataFrame([("a", "50.0%")], "proposition string, rate string")
    assert pipelines.jury_report(votes, ballots, ["a", "b", "c"], truth).count() == 3


def test_propositions_and_texts(spark, infer):
    by_opinion = spark.createDataFrame([("t", "o", ["q"])], "topic string, opinion string, quotes array<string>")
    assert pipelines.generated_propositions(infer, by_opinion).first()["propositions"] == ["one", "two", "o"]
    assert pipelines.generated_propositions(infer, by_opinion, 1).first()["propositions"] == ["o"]
    selected = spark.createDataFrame([("t", "p", 1, True), ("t", "x", 2, False)], "topic string, proposition string, rank int, selected boolean")
    assert [r["proposition"] for r in pipelines.nuanced_propositions(infer, selected).orderBy("idx").collect()] == ["first", "second"]
    assert pipelines.simplified(infer, selected).first()["simplified"] == "summary"
    quotes = spark.createDataFrame([("t", "o", "q", 0), ("t", "p", "r", 1)], "topic string, opinion string, quote string, ord bigint")
    o, t, every = pipelines.report_texts(infer, quotes)
    assert (o.count(), t.count(), every.first()["overview"]) == (2, 1, "summary")


def test_translation(spark):
    rows = spark.createDataFrame([(1, "hallo"), (2, "hallo"), (3, None), (4, " ")], "k int, t string")
    memo = Inference(spark, Canned({}, otherwise=lambda p: json.dumps({"is_target_language": False, "translation": "hello"})), partitions=1)
    got = {r["k"]: (r["t"], r["original_t"]) for r in pipelines.translated(rows, "t", memo).collect()}
    assert got == {1: ("hello", "hallo"), 2: ("hello", "hallo"), 3: (None, None), 4: (" ", " ")}
    same = Inference(spark, Canned({}, otherwise=lambda p: json.dumps({"is_target_language": True, "translation": ""})), partitions=1)
    assert {r["t"] for r in pipelines.translated(rows.limit(1), "t", same).collect()} == {"hallo"}


def test_refinement_end_to_end_and_resumed(spark):
    from plenum.operators import refinement

    asked = []

    def model(prompt):
        asked.append(prompt)
        if prompt.startswith("Which of these statements"):
            return '{"equivalence_sets": [["0:0", "1:0"], ["9:9", "0:1"]]}'
        return replies(prompt)

    opinions = spark.createDataFrame([("A", "o1", 3, ["p1", "p2"]), ("A", "o2", 2, ["p3"]), ("B", "o3", 1, ["q1", "q2"])], "topic string, opinion string, r1_length bigint, propositions array<string>")
    people = spark.createDataFrame([(1, "r1"), (2, "r2")], "participant_id int, record string")
    run = lifecycle.Run(spark, work_dir(spark))
    infer = Inference(spark, Canned(otherwise=model), partitions=1)
    real = spark.createDataFrame([("A", ["o1", "o2"])], "topic string, ranking array<string>")
    top = refinement.refine(run, infer, opinions, people, real, k=2)
    assert {(r["proposition"], r["method"]) for r in top.collect()} == {("first", "pav"), ("second", "pav")}
    stages = {r["stage"] for r in run.manifest().collect()}
    assert stages == {"r2_opinion_ranking", "approvals", "opinion_rankings", "topic_rankings", "equivalence", "selected", "nuanced", "nuanced_approvals", "nuanced_ballots", "top_nuanced"}
    again = refinement.refine(lifecycle.Run(spark, run.root), Inference(spark, Canned(), attempts=1), opinions, people, real, k=2)
    assert again.count() == top.count()
    chosen = run.read("selected").where("selected").groupBy("topic").count().collect()
    assert {r["topic"]: r["count"] for r in chosen} == {"A": 2, "B": 1}
    judge = refinement.model_judge(lambda p: "I keep 1:0")
    group = [{"proposition_id": "0:0", "topic": "A", "proposition": "x", "rank": 1}, {"proposition_id": "1:0", "topic": "B", "proposition": "y", "rank": 2}]
    assert judge(group) == "1:0" and refinement.model_judge(lambda p: "none")(group) == "0:0"


def test_refinement_tables(spark, infer):
    from plenum.operators import prompts, refinement

    r1 = spark.createDataFrame([(1, "A", "o", "q1", 0), (2, "A", "o", "q2", 1)], "participant_id int, topic string, opinion string, quote string, ord int")
    r2 = spark.createDataFrame([(1, "o", "why?", "so", 1)], "participant_id int, opinion string, question string, answer string, n int")
    row = refinement.by_opinion(r1, r2).first()
    assert (row["r1_length"], row["r2_length"], len(row["r1"]), row["r2"][0]["answer"]) == (2, 1, 2, "so")
    opinions = spark.createDataFrame([("A", "o", 2, ["p"])], "topic string, opinion string, r1_length bigint, propositions array<string>")
    rates = spark.createDataFrame([("p", 0.5)], "proposition string, approval_rate double")
    topic = refinement.enriched_topics(opinions, rates).first()
    assert topic["r1_quotes_by_topic"] == 2 and topic["propositions"][0]["approval_rate"] == 0.5
    votes = spark.createDataFrame([(1, "p", True)], "participant_id int, proposition string, approved boolean")
    assert refinement.with_rates(spark.createDataFrame([("p", 9.0)], "statement string, agree_rate double"), votes).first()["agree_rate"] == 1.0
    assert refinement.skipped_rows(r1, r1.where("participant_id = 2")).count() == 1 and refinement.with_scores(r1, r1.select("ord", "quote"), "ord").count() == 2
    assert prompts.first_round(r1).first()["text"].startswith('<participant id="1">q1</participant>')
    gallery = spark.createDataFrame([(1, 1, "q", "a")], "participant_id int, n int, question string, answer string")
    ranked = spark.createDataFrame([(1, 1, 0, "s1", 2.0), (1, 1, 1, "s2", 1.0), (1, 1, 2, "s3", None)], "participant_id int, set_no int, place int, statement string, rank double")
    assert prompts.second_round(gallery, ranked).first()["text"] == "<question>q</question><response>a</response>\n<ranking>1. s2\n2. s1\n3. s3</ranking>"
    texts = spark.createDataFrame([(0, "x", "g"), (1, "y", "g"), (2, "x", "g")], "ord int, t string, g string")
    assert prompts.with_dictionary(texts, "t", "g").first().asDict() == {"g": "g", "dictionary": "A: x", "text": "A\ny\nA"}
    props = spark.createDataFrame([("0:0", "A", "x", 1), ("1:0", "B", "y", 2)], "proposition_id string, topic string, proposition string, rank int")
    sets = spark.createDataFrame([("s", ["0:0", "1:0"])], "set_id string, members array<string>")
    named = Inference(spark, Canned(otherwise=lambda p: "B"), partitions=1)
    assert refinement.judged_topics(named, sets, props).first()["winner"] == "B" and refinement.judged_topics(infer, sets, props).first()["winner"] == "A"
    quotes = spark.createDataFrame([("Taxes", 0, "q")], "topic string, ord bigint, text string")
    assert {r["run"] for r in refinement.learned_runs(infer, quotes, 2).collect()} == {0, 1}
    wide = spark.createDataFrame([(1, "good q", "T", "a")], "participant_id bigint, question_1 string, question_1_topic string, answer_1 string")
    agrees, scored = refinement.evaluated_rounds(infer, wide, spark.createDataFrame([("good", "good", "p")], "topic string, opinion string, proposition string"))
    assert agrees.first()["answer_1_agrees"] is True and (scored.first()["topic_score"], scored.first()["opinion_score"]) == (4.0, 4.0)
    assert "brackets" in prompts.quote_criteria()
