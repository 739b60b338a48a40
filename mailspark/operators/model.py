"""The model stage: a user's function over a request table.

The caller brings the client.  The stage brings retries, a time limit per item, a bound on
simultaneous calls, one call per distinct request, and a row status in place of an abort.
"""

from __future__ import annotations

import queue
import re
import threading
import time
from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from itertools import tee

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailspark.session import materialise, work_dir
from mailspark.sources.files import path_exists

ANSWER_FIELDS = [
    T.StructField("response", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("attempts", T.IntegerType()),
    T.StructField("error", T.StringType()),
]


#: Requests, and characters in them, that a task takes up before the oldest of them is answered.
AHEAD, AHEAD_CHARS = 8_192, 64 << 20


@dataclass(frozen=True)
class CallPolicy:
    """How often to try, how long to wait in between (doubling from ``wait_min`` up to
    ``wait_max`` seconds), which errors deserve another try, and the time limit per call."""

    attempts: int = 1
    wait_min: float = 0.0
    wait_max: float = 0.0
    retry_on: tuple[type[BaseException], ...] = ()
    timeout: float | None = None

    def wait(self, failed: int) -> float:
        return min(self.wait_max, max(self.wait_min, self.wait_min * 2 ** (failed - 1)))


def scrub_policy(*errors: type[BaseException], timeout: float | None = None) -> CallPolicy:
    """Five tries, exponential wait of 1 to 60 seconds (rate limits and API errors)."""
    return CallPolicy(5, 1.0, 60.0, errors or (Exception,), timeout)


def distil_policy(*errors: type[BaseException], timeout: float | None = None) -> CallPolicy:
    """Three tries without a wait (lost connections)."""
    return CallPolicy(3, 0.0, 0.0, errors or (ConnectionError,), timeout)


def rewrite_policy(timeout: float | None = None) -> CallPolicy:
    """One try; a failed rewrite keeps the record."""
    return CallPolicy(timeout=timeout)


def choose_model(argument: str | None, stage: str | None, general: str | None, default: str) -> str:
    """First non-empty of: argument, setting of the stage, general setting, default."""
    return next((m.strip() for m in (argument, stage, general) if m and m.strip()), default)


class TierError(ValueError):
    """A table that may not leave the house was about to be sent to a public endpoint."""


def check_tier(tier: str, public_endpoint: bool) -> None:
    if public_endpoint and tier != "scrubbed":
        raise TierError(f"only scrubbed text may go to a public endpoint, this is {tier!r}")


class CallTimeout(Exception):
    """No answer within the time limit."""


def _limited(fn, messages, options, seconds: float | None):
    """Call ``fn``; give up waiting after ``seconds``.  A call that hangs keeps its own
    daemon thread and blocks nobody else."""
    if seconds is None:
        return fn(messages, **options)
    box: queue.SimpleQueue = queue.SimpleQueue()

    def target():
        try:
            box.put((fn(messages, **options), None))
        except Exception as error:
            box.put((None, error))

    threading.Thread(target=target, daemon=True).start()
    try:
        answer, error = box.get(timeout=seconds)
    except queue.Empty:
        raise CallTimeout(f"no answer within {seconds} s") from None
    if error is not None:
        raise error
    return answer


def _call_once(fn, messages, options, policy: CallPolicy):
    """(response, status, attempts, error) of one request."""
    for attempt in range(1, policy.attempts + 1):
        try:
            return _limited(fn, messages, options, policy.timeout), "ok", attempt, None
        except CallTimeout as error:
            return None, "timeout", attempt, str(error)
        except Exception as error:
            if attempt == policy.attempts or not isinstance(error, policy.retry_on):
                return None, "error", attempt, f"{type(error).__name__}: {error}"
            time.sleep(policy.wait(attempt))
    return None, "error", 0, "no attempt allowed"


#: Bytes of written requests that one task reads, where the number of tasks is bounded.
PER_TASK = 128 << 20


def _waves(requests: DataFrame, tasks: int, per_task: int | None = None) -> Iterator[DataFrame]:
    """The requests, written out once, in parts of at most ``tasks`` partitions that read ``per_task`` bytes each, about.

    Few tasks thus never share out a whole table, and what makes the requests keeps all its tasks."""
    spark, path, most = requests.sparkSession, work_dir(requests.sparkSession, "requests"), tasks * (per_task or PER_TASK)
    materialise(requests, path)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select("path", "length").collect()  # one row per written part
    parts, size = [[]], 0
    for path, length in sorted(map(tuple, files)):
        if parts[-1] and size + length > most:
            parts, size = [*parts, []], 0
        parts[-1].append(re.sub(r"([\[\]{}*?\\])", r"\\\1", path))
        size += length
    for part in filter(None, parts):
        rows = spark.read.schema(requests.schema).parquet(*part)
        yield rows.coalesce(tasks) if len(part) >= tasks else rows.repartition(tasks)


def call_model(
    df: DataFrame,
    connect: Callable[[], Callable[..., str]],
    *,
    model: str,
    temperature: float = 0.1,
    json_mode: bool = False,
    policy: CallPolicy = CallPolicy(),
    concurrency: int | None = None,
    threads: int = 1,
    in_flight: int | None = None,
    dedupe: bool = False,
    tier: str = "scrubbed",
    public_endpoint: bool = True,
    on_error: str = "status",
    answers_path: str | None = None,
    log: str | None = None,
    waves: int = 4,
) -> DataFrame:
    """Add ``response, status, attempts, error`` to a table with ``messages``.

    ``connect()`` runs once per task and returns ``fn(messages, model=, temperature=,
    json_mode=) -> text``; a task without rows never connects.

    Requests are called where their rows lie; no text is shuffled.  With ``dedupe`` equal
    requests are called once, which costs two shuffles of the requests and pays where many are
    equal: they are reduced to one row per hash (at most one copy per task of a hot request is
    moved), and the answers come back by an equi-join on the hash.  Either way answers are
    written out before anything reads them, so no later action pays for a call twice.

    ``log`` names a table of answers that outlives the run: requests (by hash of messages, model
    and options) with a good answer in it are not called, all others are, in ``waves`` jobs that
    append to it.  A run that dies is started again with the same log and pays for the wave
    that it was in, not for those before.

    ``threads`` calls run at once in each task, which takes up later requests while a slow call holds
    up an earlier one (AHEAD bounds how many); the cluster's slots bound the tasks.
    ``concurrency`` bounds them further, for trial runs and endpoints that allow few calls: requests
    are then written out and called in one job after another, each with so many tasks of bounded input.
    ``in_flight`` bounds the calls of the whole cluster, whatever its slots: it is shared out to so
    many tasks that their threads add up to no more.  Speculative tasks would call beside it.
    """
    check_tier(tier, public_endpoint)
    if in_flight is not None:
        threads = max(1, min(threads, in_flight))
        tasks = max(1, in_flight // threads)
        concurrency = tasks if concurrency is None else min(concurrency, tasks)
    options = {"model": model, "temperature": temperature, "json_mode": json_mode}
    schema = T.StructType([T.StructField("request_hash", T.StringType()), *ANSWER_FIELDS])
    names = schema.fieldNames()
    width = max(1, threads)

    def answers_of(columns: Iterator[pd.Series]) -> Iterator[list[tuple]]:
        fn, waiting = None, deque()
        ahead, room = (AHEAD, AHEAD_CHARS) if width > 1 else (0, 0)
        callers = ThreadPoolExecutor(width)

        def oldest() -> list[tuple]:
            answers = [call.result() for call in waiting.popleft()[0]]
            for answer in answers:
                if on_error == "fail" and answer[1] != "ok":
                    raise RuntimeError(f"model call failed ({answer[1]}): {answer[3]}")
            return answers

        try:
            for column in columns:
                if fn is None and len(column):
                    fn = connect()
                requests = [[dict(m) for m in messages] for messages in column]
                size = sum(len(m.get("content") or "") for messages in requests for m in messages) if ahead else 0
                waiting.append(([callers.submit(_call_once, fn, m, options, policy) for m in requests], len(requests), size))
                while waiting and (sum(w[1] for w in waiting) > ahead or sum(w[2] for w in waiting) > room or all(c.done() for c in waiting[0][0])):
                    yield oldest()
            while waiting:
                yield oldest()
        finally:
            callers.shutdown(cancel_futures=True)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        batches, hashes = tee(batches)
        for batch, answers in zip(hashes, answers_of(b["messages"] for b in batches)):
            rows = [(h, *answer) for h, answer in zip(batch["request_hash"], answers)]
            yield pd.DataFrame(rows, columns=names).astype({"attempts": "int32"})

    if log is not None:
        asked = F.sha2(F.to_json(F.struct("messages", *[F.lit(v).alias(k) for k, v in options.items()])), 256)
        requests = df.select(asked.alias("request_hash"), "messages")
        requests = requests.dropDuplicates(["request_hash"]) if dedupe else requests
        for wave in range(max(1, waves)):
            due = requests.filter(F.pmod(F.xxhash64("request_hash"), F.lit(max(1, waves))) == wave)
            if path_exists(df.sparkSession, log):
                good = df.sparkSession.read.schema(schema).parquet(log).filter("status = 'ok'")
                due = due.join(good.select("request_hash").distinct(), "request_hash", "left_anti")
            for part in [due] if concurrency is None else _waves(due, max(1, concurrency)):
                part.mapInPandas(run, schema).write.mode("append").parquet(log)
        # The good answer of a request, where it has one; failed tries stay in the log.
        best = F.max_by(F.struct(*names[1:]), F.struct(F.col("status") == "ok", "response", "attempts"))
        answers = df.sparkSession.read.schema(schema).parquet(log).groupBy(F.col("request_hash").alias("_request")).agg(best.alias("_answer"))
        return df.withColumn("_request", asked).join(answers, "_request", "left").select(*df.columns, "_answer.*")

    def answered(requests: DataFrame, called: Callable[[DataFrame], DataFrame]) -> DataFrame:
        if concurrency is None:
            return materialise(called(requests), answers_path)
        out, mode = answers_path or work_dir(df.sparkSession, "table"), "overwrite"
        for part in _waves(requests, max(1, concurrency)):
            called(part).write.mode(mode).parquet(out)
            mode = "append"
        return df.sparkSession.read.schema(called(requests).schema).parquet(out)

    if not dedupe:

        @F.pandas_udf(T.StructType(ANSWER_FIELDS))
        def call(columns: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            for answers in answers_of(columns):
                yield pd.DataFrame(answers, columns=names[1:]).astype({"attempts": "int32"})

        return answered(df, lambda part: part.withColumn("_answer", call.asNondeterministic()("messages")).select(*df.columns, "_answer.*"))

    hashed = df.withColumn("request_hash", F.sha2(F.to_json("messages"), 256))
    distinct = hashed.groupBy("request_hash").agg(F.first("messages").alias("messages"))
    answers = answered(distinct, lambda part: part.mapInPandas(run, schema))
    return hashed.join(answers, "request_hash", "left")
