"""One inference operator for all model steps: jobs in, replies out, once each.

Equal prompts are asked once; jobs that the ledger has are not asked again; a partition asks with a bounded number of
calls at a time, retries by the error's kind and writes one row a job.  Replies are written before anything reads them,
so that a lost executor or a second action never asks again.  Speculative execution must be off for the same reason.
"""

from __future__ import annotations

import asyncio
import hashlib
import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codecs
from ..session import materialised

# Retries, waits and limits of the executor.
ATTEMPTS, CONCURRENT, PAUSE, WARMER, BACKOFF, LONGEST = 3, 20, 0.1, 0.02, 2.0, 64.0

REPLY = "job_key string, response string, status string, error string, attempts int, tokens_in bigint, tokens_out bigint, seconds double, failed_tries array<struct<attempt_index:int,error_message:string,raw_response:string>>"


class Busy(Exception):
    """The service asks to wait (429, 503); such a try doesn't count."""

    def __init__(self, message: str, wait: float | None = None):
        super().__init__(message)
        self.wait = wait


class Provider:
    """What answers prompts (M04, M06).  Instances are sent to executors."""

    def ask(self, prompt: str, system: str | None, schema: str | None, temperature: float) -> str:
        raise NotImplementedError


@dataclass
class Canned(Provider):
    """Replies from a table, or a function of the prompt; for tests and offline runs."""

    replies: dict[str, str] = field(default_factory=dict)
    otherwise: Callable[[str], str] | None = None

    def ask(self, prompt: str, system: str | None, schema: str | None, temperature: float) -> str:
        if prompt in self.replies:
            return self.replies[prompt]
        if self.otherwise is None:
            raise ValueError("no reply to this prompt")
        return self.otherwise(prompt)


def digest_score(prompt: str) -> str:
    """A judge's reply whose score, from 0 to 4, follows from the prompt's digest: a stand-in, not a judgement."""
    return json.dumps({"score": int(hashlib.md5(prompt.encode()).hexdigest()[:8], 16) / 2**32 * 4, "explanation": "by digest"})


@dataclass
class ChatCompletions(Provider):
    """A service with the widespread chat completions interface."""

    url: str
    model: str
    key: str = ""
    style: str = "json_schema"
    timeout: float = 601.0

    def body(self, prompt: str, system: str | None, schema: str | None, temperature: float) -> dict:
        messages = [{"role": "system", "content": system}] * bool(system) + [{"role": "user", "content": prompt}]
        out = {"model": self.model, "messages": messages, "temperature": temperature}
        if schema:
            kind = {"type": "json_schema", "json_schema": {"name": "reply", "schema": json.loads(schema)}} if self.style == "json_schema" else {"type": "json_object"}
            out["response_format"] = kind
        return out

    def ask(self, prompt: str, system: str | None, schema: str | None, temperature: float) -> str:
        request = urllib.request.Request(self.url, json.dumps(self.body(prompt, system, schema, temperature)).encode(), {"Content-Type": "application/json", "Authorization": f"Bearer {self.key}"})
        try:
            with urllib.request.urlopen(request, timeout=self.timeout) as answer:
                choice = json.load(answer)["choices"][0]
        except urllib.error.HTTPError as e:
            if e.code in (429, 503):
                raise Busy(str(e), float(e.headers.get("Retry-After") or 0) or None) from e
            raise
        if choice.get("finish_reason") not in ("stop", None):
            raise ValueError(f"the reply ended with {choice['finish_reason']}")
        return choice["message"]["content"]


def provider_by_name(name: str, **options) -> Provider:
    """M06"""
    return {"canned": Canned, "chat_completions": ChatCompletions}[name](**options)


def wait_after(n: int, asked: float | None = None) -> float:
    """Seconds to wait when the service is busy for the n-th time (M03): what it asks for and one more, else powers, at most 64."""
    return asked + 1 if asked else min(BACKOFF ** (n + 1), LONGEST)


async def _run(jobs: list[dict], provider: Provider, valid: Callable[[str], bool] | None, attempts: int, concurrent: int, sleep) -> list[dict]:
    gate, clear = asyncio.Semaphore(concurrent), asyncio.Event()
    clear.set()
    busy = 0

    async def one(job: dict) -> dict:
        nonlocal busy
        failed, n, warmth, began = [], 0, job.get("temperature") or 0.0, time.time()
        async with gate:
            while n < attempts:
                await clear.wait()
                try:
                    reply = await asyncio.to_thread(provider.ask, job["prompt"], job.get("system_prompt"), job.get("response_schema"), warmth)
                    if valid is None or valid(reply):
                        return {"response": reply, "status": "ok", "error": None, "attempts": n + 1, "failed_tries": failed, "seconds": time.time() - began}
                    error, raw = "the reply does not hold", reply
                except Busy as e:
                    if clear.is_set():  # all jobs of the partition wait, and none loses a try
                        clear.clear()
                        await sleep(wait_after(busy, e.wait))
                        busy += 1
                        clear.set()
                    continue
                except Exception as e:  # noqa: BLE001  any failure of a call is a failed try
                    error, raw = str(e) or type(e).__name__, None
                failed.append({"attempt_index": n, "error_message": error, "raw_response": raw})
                n, warmth = n + 1, warmth + WARMER
                await sleep(PAUSE)
        return {"response": None, "status": "error", "error": failed[-1]["error_message"] if failed else None, "attempts": n, "failed_tries": failed, "seconds": time.time() - began}

    return list(await asyncio.gather(*map(one, jobs)))


def _partition(provider: Provider, valid, attempts: int, concurrent: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            jobs = pdf.astype(object).where(pdf.notna(), None).to_dict("records")
            replies = asyncio.run(_run(jobs, provider, valid, attempts, concurrent, asyncio.sleep))
            rows = [r | {"job_key": j["job_key"], "tokens_in": len(j["prompt"]) // 4, "tokens_out": len(r["response"] or "") // 4} for j, r in zip(jobs, replies)]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in REPLY.split(", ")])

    return run


@dataclass
class Inference:
    """The operator (M01, M02).  ``ledger``: a folder of replies that are kept from run to run."""

    spark: SparkSession
    provider: Provider
    ledger: str | None = None
    attempts: int = ATTEMPTS
    concurrent: int = CONCURRENT
    partitions: int = 8

    def done(self) -> DataFrame:
        empty = self.spark.createDataFrame([], f"stage string, {REPLY}")
        if self.ledger is None:
            return empty
        try:
            return self.spark.read.schema(empty.schema).parquet(self.ledger)
        except Exception as e:  # noqa: BLE001
            if "PATH_NOT_FOUND" in str(e):
                return empty
            raise

    def __call__(self, jobs: DataFrame, stage: str, schema: str | None = None, valid: Callable[[str], bool] | None = None) -> DataFrame:
        """``jobs`` (prompt, and whatever else) with the reply's columns; ``parsed`` by ``schema``, if given.

        The order of jobs is theirs to restore by a column of theirs (O12).
        """
        for c in ("system_prompt", "response_schema"):
            if c not in jobs.columns:
                jobs = jobs.withColumn(c, F.lit(None).cast("string"))
        if "temperature" not in jobs.columns:
            jobs = jobs.withColumn("temperature", F.lit(0.0))
        keyed = jobs.withColumn("job_key", F.sha2(F.concat_ws("\u0001", F.lit(stage), "prompt", F.coalesce("system_prompt", F.lit("")), F.coalesce("response_schema", F.lit("")), F.col("temperature").cast("string")), 256))
        distinct = keyed.select("job_key", "prompt", "system_prompt", "response_schema", "temperature").dropDuplicates(["job_key"])
        old = self.done().where((F.col("stage") == stage) & (F.col("status") == "ok")).drop("stage").dropDuplicates(["job_key"])
        asked = distinct.join(old.select("job_key"), "job_key", "left_anti").repartition(self.partitions, "job_key")
        new = asked.mapInPandas(_partition(self.provider, valid, self.attempts, self.concurrent), REPLY)
        if self.ledger is None:
            new = materialised(new)
        else:
            new.withColumn("stage", F.lit(stage)).select("stage", *new.columns).write.mode("append").parquet(self.ledger)
            new = self.done().where(F.col("stage") == stage).drop("stage")
            new = new.groupBy("job_key").agg(*(F.max_by(c, F.struct((F.col("status") == "ok"), "attempts")).alias(c) for c in new.columns if c != "job_key"))
        replies = new if self.ledger is not None else new.unionByName(old)
        out = keyed.join(replies, "job_key", "left")
        return out.withColumn("parsed", codecs.parse_reply(F.col("response"), schema)) if schema else out


def stage_summary(ledger: DataFrame) -> DataFrame:
    """Calls, successes, retries, tokens and time by stage."""
    return ledger.groupBy("stage").agg(F.count("*").alias("jobs"), F.count_if(F.col("status") == "ok").alias("ok"), F.sum("attempts").alias("calls"), F.sum("tokens_in").alias("tokens_in"), F.sum("tokens_out").alias("tokens_out"), F.sum("seconds").alias("seconds"))


def retry_histogram(ledger: DataFrame) -> DataFrame:
    """How many jobs failed how often."""
    return ledger.groupBy(F.size("failed_tries").alias("failed_tries")).count()


def with_retries(call: Callable[[], object], valid: Callable[[object], bool], attempts: int = ATTEMPTS, wait: float = 1.0, sleep=time.sleep) -> object:
    """A call on the driver until its value holds (M10); waits grow by half, to a minute."""
    for _ in range(attempts):
        value = call()
        if valid(value):
            return value
        sleep(wait)
        wait = min(wait * 1.5, 60.0)
    raise ValueError(f"no value held in {attempts} attempts")


def preview(prompts: DataFrame, head: int = 2_000, tail: int = 11) -> DataFrame:
    """Beginnings and ends of prompts."""
    p = F.col("prompt")
    return prompts.withColumn("preview", F.when(F.length(p) > head + tail, F.concat(F.substring(p, 1, head), F.lit("\n...\n"), F.right(p, F.lit(tail)))).otherwise(p))
