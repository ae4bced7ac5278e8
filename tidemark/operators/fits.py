"""Many fits side by side, each remembered as soon as it is done.

A fit of Spark ML is a row of short jobs, which leave most of a cluster idle. ``concurrently`` starts several fits from
threads of the driver; each thread has a scheduler pool of its own, so that with ``spark.scheduler.mode`` FAIR all get
their share of the tasks. What a fit finds is written by ``append_once`` to a folder named after what was asked, so a
study that was stopped goes on where it was, and a run that is repeated adds nothing.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.tables import append_once, read_runs, run_done

THREADS = 8


def concurrently(calls: Sequence[Callable[[], object]], threads: int = THREADS, spark: SparkSession | None = None) -> list:
    """What each call gives, in their order. If some fail, the others are finished before the first failure is raised."""
    spark = spark or SparkSession.active()
    if threads <= 1 or len(calls) <= 1:
        return [call() for call in calls]

    def begin(call: Callable[[], object], pool: int):
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"fit-{pool}")
        try:
            return call()
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(threads) as pool:
        waiting = [pool.submit(inheritable_thread_target(spark)(begin), call, i % threads) for i, call in enumerate(calls)]
    return [w.result() for w in waiting]


def run_name(values: Mapping[str, object]) -> str:
    """A folder name for a tuple of parameters, the same for equal values in any order."""
    return hashlib.sha256(json.dumps(dict(values), sort_keys=True, default=str).encode()).hexdigest()[:32]


def study(
    spark: SparkSession,
    points: Sequence[Mapping[str, object]],
    run: Callable[[Mapping[str, object]], DataFrame],
    path: str,
    threads: int = THREADS,
) -> DataFrame:
    """The rows of ``run`` for every point, stored below ``path``; points that are stored already are not run again.

    ``run`` gives a few rows for a point, all with the same columns.
    """
    points = list({run_name(p): p for p in points}.values())
    todo = [p for p in points if not run_done(spark, path, run_name(p))]
    concurrently([lambda p=p: append_once(run(p), path, run_name(p)) for p in todo], threads, spark)
    return read_runs(spark, path)
