"""Keyed request sweeps: one request per key, spread over the executors.

A long sweep runs in lots: the requests are written lot by lot, a stream reads them and some lots make a commit. A
restarted sweep goes on after the last commit that was answered. As long as answers come fast, several commits are
asked for in one job, so that the number of jobs grows with the time the requests take, not with the number of commits.
"""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from transitloom.operators.numbering import in_lots
from transitloom.session import folders_in

_FLUSH = 64  # replies held in a task before they are handed back
#: Lots, and so commits, of one micro-batch at most; seconds that the requests of one job should take.
LOTS_AT_ONCE, JOB_SECONDS = 4096, 30.0
#: Lots that share a file of requests; queues with a folder named for each lot have files of one lot.
LOTS_IN_FILE = 64


class Pace:
    """The times at which one of several tasks may send a request, so that all of them keep to a common rate.

    Slots lie 1 / rate apart on the wall clock; task i of n has every n-th of them, from the i-th on, and sends one request
    in each. A task that starts late or is held up waits for its next slot and never catches up, so tasks need not know of
    each other. A retry takes a slot like any other request.
    """

    def __init__(self, per_second: float, tasks: int, task: int, clock: Callable[[], float] = time.time,
                 sleep: Callable[[float], None] = time.sleep) -> None:
        if per_second <= 0:
            raise ValueError("the rate must be positive")
        self.rate, self.tasks, self.task, self.clock, self.sleep = per_second, tasks, task, clock, sleep
        self.last = math.floor((clock() * per_second - task) / tasks)

    def wait(self) -> None:
        """Return when the next slot has come."""
        now = self.clock()
        self.last = max(self.last + 1, math.ceil((now * self.rate - self.task) / self.tasks))
        self.sleep(max(0.0, (self.last * self.tasks + self.task) / self.rate - now))


def sweep(requests: DataFrame, key: str, fetch: Callable[[object], str | None], tasks: int,
          attempts: int = 3, wait_seconds: float = 5.0, per_second: float | None = None) -> DataFrame:
    """Run ``fetch(key)`` for every key; a failing key is a row, not an error.

    Returns the key with ``status`` (ok, empty, failed), ``attempt`` (tries used), ``body`` and
    ``error``. ``fetch`` returns the reply text and raises on failure; each key is tried up to
    ``attempts`` times, ``wait_seconds`` apart, and all tasks together send at most ``per_second`` requests a second, retries
    included. Other columns of ``requests`` come along. A lost task
    repeats its requests, so write the result to the landing zone once and parse it from there.
    """
    kept = requests.columns
    answer = T.StructType.fromDDL("status string, attempt int, body string, error string")
    schema = T.StructType([*requests.schema.fields, *answer.fields])

    def ask(value, pace: Pace | None) -> tuple:
        error = None
        for attempt in range(1, attempts + 1):
            if pace:
                pace.wait()
            try:
                body = fetch(value)
            except Exception as problem:  # any failure of one request is data about that request
                error = str(problem)
                if attempt < attempts:
                    time.sleep(wait_seconds)
                continue
            if body is None or body.strip() in ("", "[]", "{}", "null"):
                return "empty", attempt, body, None
            return "ok", attempt, body, None
        return "failed", attempts, None, error

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pace = Pace(per_second, tasks, TaskContext.get().partitionId() % tasks) if per_second else None
        for batch in batches:
            for start in range(0, len(batch), _FLUSH):
                part = batch.iloc[start:start + _FLUSH].reset_index(drop=True)
                answers = pd.DataFrame([ask(v, pace) for v in part[key].tolist()], columns=answer.names)
                yield pd.concat([part[kept], answers], axis=1)

    return requests.repartition(tasks, F.col(key)).mapInPandas(run, schema)


def attempts_summary(replies: DataFrame) -> DataFrame:
    """Requests made and how they ended."""
    return replies.groupBy("status").agg(
        F.count(F.lit(1)).alias("requests"), F.sum("attempt").alias("attempts")
    )


def write_lots(keys: DataFrame, key: str, size: int, folder: str) -> None:
    """Requests in lots of ``size`` keys, as files of LOTS_IN_FILE lots: the stream lists all files and every job opens them."""
    lots = in_lots(keys, key, size).withColumn("lotes", F.floor(F.col("lote") / LOTS_IN_FILE))
    lots.repartition("lotes").write.partitionBy("lotes").parquet(folder)


def ask_again(spark: SparkSession, requests: str, key: str, replies: str) -> None:
    """Queue the keys whose last answer is a failure, under the lot they had: in files like those of the queue."""
    failed = last_replies(spark, replies, key).filter(F.col("status") == "failed").select(key, "lote")
    by = "lotes" if folders_in(spark, requests, "lotes=") else "lote"
    if by == "lotes":
        failed = failed.withColumn(by, F.floor(F.col("lote") / LOTS_IN_FILE))
    # a file per folder, as the stream counts files
    failed.repartition(by).write.mode("append").partitionBy(by).parquet(requests)


def last_replies(spark: SparkSession, replies: str, key: str) -> DataFrame:
    """The answer of every key from the last commit that asked for it."""
    every = spark.read.parquet(replies)
    latest = Window.partitionBy(key).orderBy(F.col("commit").desc())
    return every.withColumn("__rank", F.row_number().over(latest)).filter("__rank = 1").drop("__rank")


def sweep_lots(spark: SparkSession, requests: str, key: str, fetch: Callable[[object], str | None],
               replies: str, checkpoint: str, tasks: int, lots_per_commit: int = 1,
               written: Callable[[DataFrame, list[int]], None] | None = None, **options) -> StreamingQuery:
    """Sweep the lots written by :func:`write_lots`, some lots per commit.

    Every commit has a folder of its own under ``replies``, which appears when all of it is answered. One job asks for one
    commit at first and for twice as many as the last one while that takes less than ``JOB_SECONDS``: an interrupted sweep
    loses the answers of one job, and asks again for the commits without a folder only. The replies of each job go with the
    numbers of its commits to ``written``, which may get commits again after an interruption. Read the replies of all
    commits from ``replies``.
    """
    at_once = 1

    def ask(batch: DataFrame, batch_id: int) -> None:
        nonlocal at_once
        lots = sorted(r[0] for r in batch.select("lote").distinct().collect())
        commits = {batch_id * LOTS_AT_ONCE + i // lots_per_commit: lots[i:i + lots_per_commit] for i in range(0, len(lots), lots_per_commit)}
        there = {int(f.partition("=")[2]) for f in folders_in(batch.sparkSession, replies, "commit=")}
        if written is not None and there & commits.keys():
            written(_replies_of(spark, replies, sorted(there & commits.keys())), sorted(there & commits.keys()))
        waiting = sorted(commits.keys() - there)
        while waiting:
            now, waiting = waiting[:at_once], waiting[at_once:]
            began = time.monotonic()
            which = batch.sparkSession.createDataFrame([(lot, c) for c in now for lot in commits[c]], "lote bigint, commit bigint")
            asked = sweep(batch.join(F.broadcast(which), "lote").select(key, "lote", "commit"), key, fetch, tasks, **options)
            # a commit's folder is moved into its place when the job has ended; one file holds a commit
            asked.hint("rebalance", "commit").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("commit").parquet(replies)
            took = time.monotonic() - began
            at_once = at_once * 2 if took < JOB_SECONDS else max(1, at_once // 2) if took > 2 * JOB_SECONDS else at_once
            if written is not None:
                written(_replies_of(spark, replies, now), now)

    at_most = max(lots_per_commit, LOTS_AT_ONCE // lots_per_commit * lots_per_commit)
    in_file = 1 if folders_in(spark, requests, "lote=") else LOTS_IN_FILE
    source = spark.readStream.schema(f"{key} int, lote bigint").option(
        "maxFilesPerTrigger", math.ceil(at_most / in_file)).parquet(requests)
    return (source.writeStream.foreachBatch(ask).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def _replies_of(spark: SparkSession, replies: str, commits: list[int]) -> DataFrame:
    return spark.read.option("basePath", replies).parquet(*(f"{replies}/commit={c}" for c in commits))


def lot_origin(lot: Column, size: int, stamp: str, prefix: str = "batch") -> Column:
    """Lineage name of a lot: the position of its first key and the run."""
    return F.concat(F.lit(f"{prefix}_"), (lot * size).cast("string"), F.lit(f"_{stamp}.json"))
