"""One run at a time on a target, by a lock file in the shared state folder.

A lock is a file that is created only if it is not there, beside the target's state. Two runs of
one target thus give the rows they would give one after the other: the second waits, then reads
the state, recovers what is staged and loads what is left. The holder writes a beat into its lock
now and then; a lock without a beat for ``stale_after`` seconds belongs to a run that died, and
whoever succeeds in renaming it away goes on. Locks are taken in the order of target names, so
runs that share several targets cannot wait for each other in a circle.
"""
from __future__ import annotations

import json
import threading
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import quote

from pyspark.sql import SparkSession

from .. import fs
from ..errors import TargetBusyError

#: Fixed values (seconds): between beats, until a lock without one is stale, between looks at it.
BEAT = 30.0
STALE_AFTER = 600.0
LOOK = 0.5


def lock_path(state_path: str, dataset: str, target: str) -> str:
    return f"{state_path}/_locks/{quote(dataset, safe='')}/{quote(target, safe='')}.lock"


def _content(owner: str) -> str:
    return json.dumps({"owner": owner, "beat": time.time()})


def _read(spark: SparkSession, path: str) -> dict | None:
    """The lock's owner and last beat; None if it is gone. A lock being written has no content yet
    and counts as beating now."""
    try:
        text = fs.read_text(spark, path)
    except Exception:
        if not fs.exists(spark, path):
            return None
        raise
    return json.loads(text) if text else {"owner": "", "beat": time.time()}


def _take(spark: SparkSession, path: str, owner: str, wait: float, stale_after: float) -> None:
    until = time.monotonic() + wait
    while not fs.create_if_absent(spark, path, _content(owner)):
        held = _read(spark, path)
        if held is None:
            continue
        if time.time() - held["beat"] > stale_after:
            try:  # of several that try, one finds the file still there
                fs.rename(spark, path, f"{path}.{uuid.uuid4().hex}.stale")
            except OSError:
                pass
            continue
        if time.monotonic() > until:
            raise TargetBusyError(f"{path} is held by run {held['owner']}")
        time.sleep(LOOK)


def _holds(spark: SparkSession, path: str, owner: str) -> bool:
    held = _read(spark, path)
    return held is not None and held["owner"] == owner


@contextmanager
def target_locks(spark: SparkSession, state_path: str, dataset: str, targets: list[str], owner: str,
                 wait: float = 24 * 3600.0, stale_after: float = STALE_AFTER) -> Iterator[None]:
    """Holds the locks of a dataset's targets; raises TargetBusyError after ``wait`` seconds."""
    # runs of one name (a retry beside its first attempt) are different owners
    me = f"{owner}/{uuid.uuid4().hex[:8]}"
    stop = threading.Event()
    held: list[str] = []

    def beat() -> None:
        while not stop.wait(min(BEAT, stale_after / 3)):
            for path in list(held):
                if _holds(spark, path, me):
                    fs.write_text(spark, path, _content(me))

    beats = threading.Thread(target=beat, daemon=True)
    beats.start()
    try:
        for name in sorted(set(targets)):
            path = lock_path(state_path, dataset, name)
            _take(spark, path, me, wait, stale_after)
            held.append(path)
        yield
    finally:
        stop.set()
        beats.join()  # a beat after this would bring a lock back
        for path in reversed(held):
            if _holds(spark, path, me):
                fs.delete(spark, path)
