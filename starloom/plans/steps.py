"""Optional step timing of the pipelines (``STARLOOM_PROFILE=1`` prints
one line per step to stderr)."""

from __future__ import annotations

import os
import sys
import time
from contextlib import contextmanager


@contextmanager
def step(name: str):
    if not os.environ.get("STARLOOM_PROFILE"):
        yield
        return
    t = time.time()
    yield
    print(f"[starloom] {name}: {time.time() - t:.2f}s", file=sys.stderr, flush=True)


def run_concurrently(tasks: list, max_workers: int = 8) -> list:
    """Run independent Spark actions (table writes) as concurrent jobs.

    Each callable submits its own job from a driver thread; the scheduler
    interleaves their tasks, so small writes overlap their fixed latency
    instead of queueing.  Exceptions propagate.
    """
    from concurrent.futures import ThreadPoolExecutor

    from pyspark import inheritable_thread_target
    from pyspark.sql import SparkSession
    if len(tasks) <= 1:
        return [t() for t in tasks]
    with ThreadPoolExecutor(max_workers=min(max_workers, len(tasks))) as pool:
        # Job groups and other local properties of this thread hold for the tasks, too.
        session = SparkSession.getActiveSession()
        keep = inheritable_thread_target(session) if session else inheritable_thread_target
        return [f.result() for f in [pool.submit(keep(t)) for t in tasks]]
