"""Jobs of several feeds at a time."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from queue import Empty, SimpleQueue

from pyspark import InheritableThread
from pyspark.sql import SparkSession


def run_side_by_side(spark: SparkSession, tasks: Mapping[str, Callable[[], object]], threads: int) -> tuple[dict[str, object], dict[str, Exception]]:
    """Results and errors of the tasks by name, ``threads`` of them at a time.

    Each task's Spark jobs run in a scheduler pool of its name, which FAIR
    scheduling (``spark.scheduler.mode``) gives an equal share, and carry a tag
    of their own: if a task fails, the jobs it left behind are cancelled, and
    those of the others go on.
    """
    waiting: SimpleQueue = SimpleQueue()
    for item in tasks.items():
        waiting.put(item)
    results: dict[str, object] = {}
    errors: dict[str, Exception] = {}
    context = spark.sparkContext

    def work() -> None:
        while True:
            try:
                name, task = waiting.get_nowait()
            except Empty:
                return
            tag = f"{name}-{uuid.uuid4().hex}".replace(",", "-")
            context.setLocalProperty("spark.scheduler.pool", name)
            context.addJobTag(tag)
            try:
                results[name] = task()
            except Exception as error:  # whatever is wrong with a task, the others go on
                errors[name] = error
                context.cancelJobsWithTag(tag)
            finally:
                context.removeJobTag(tag)
                context.setLocalProperty("spark.scheduler.pool", None)

    workers = [InheritableThread(target=work, session=spark) for _ in range(max(1, min(threads, len(tasks))))]
    for worker in workers:
        worker.start()
    for worker in workers:
        worker.join()
    return results, errors
