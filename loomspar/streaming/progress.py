"""Progress of jobs over a stream of polls, and state that expires."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Iterator
from typing import Any, Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

STUCK_MS = 120_000
OUT = "job string, count bigint, best bigint, at bigint, stuck boolean, complete boolean"


def track(polls: DataFrame, total: int, stuck_ms: int = STUCK_MS) -> DataFrame:
    """job, count, best, at, stuck, complete after every batch of polls (job string, at bigint in ms, count bigint). A job
    is stuck if the largest count hasn't grown for more than stuck_ms."""

    def step(key: tuple[str], batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        best, moved = state.get if state.exists else (0, None)
        last = None
        for b in batches:
            for at, count in b.sort_values("at")[["at", "count"]].itertuples(index=False):
                moved = at if moved is None else moved
                if count > best:
                    best, moved = int(count), int(at)
                if last is None or at >= last[0]:
                    last = (int(at), int(count))
        if last is None:
            return
        state.update((int(best), int(moved)))
        yield pd.DataFrame([(key[0], last[1], best, last[0], last[0] - moved > stuck_ms, last[1] >= total)], columns=["job", "count", "best", "at", "stuck", "complete"])

    return polls.groupBy("job").applyInPandasWithState(step, OUT, "best bigint, moved bigint", "update", GroupStateTimeout.NoTimeout)


def follow(poll: Callable[[], int], total: int, on_progress: Callable[[dict], None], every: float = 2.0, stuck_ms: int = STUCK_MS, clock: Callable[[], float] = time.monotonic, wait: Callable[[float], object] = time.sleep) -> dict:
    """Calls on_progress at once and then every so many seconds with {count, best, at, stuck, complete}, until the count is
    complete or hasn't grown for more than stuck_ms. Returns the last one."""
    start = clock()
    best, moved = 0, 0
    while True:
        at, count = int((clock() - start) * 1000), poll()
        if count > best:
            best, moved = count, at
        now = {"count": count, "best": best, "at": at, "stuck": at - moved > stuck_ms, "complete": count >= total}
        on_progress(now)
        if now["complete"] or now["stuck"]:
            return now
        wait(every)


class CacheAdapter(Protocol):
    """What a cache of another kind (shared by several processes, say) has to offer."""

    def set(self, key: tuple, value: Any, ttl: float) -> None: ...

    def get(self, key: tuple, stale: bool = True) -> tuple[Any, bool] | None: ...

    def invalidate(self, wanted: Callable[[tuple], bool] = ...) -> list[tuple]: ...


class Lookups:
    """Lists of a project's values by the type of their field and, if given, of the issue; kept for a while in any cache.
    The keys that were set are on record, also where the cache can't list them."""

    def __init__(self, cache: CacheAdapter, ttl: float = 900.0) -> None:
        self._cache, self._ttl = cache, ttl
        self.tracked: set[tuple] = set()

    @staticmethod
    def key(project: str, field_type: str, issue_type: str | None = None) -> tuple:
        return ("lookup", project, field_type) + (() if issue_type is None else (issue_type,))

    def get(self, project: str, field_type: str, issue_type: str | None = None) -> Any:
        found = self._cache.get(self.key(project, field_type, issue_type), stale=False)
        return found[0] if found else None

    def set(self, project: str, field_type: str, value: Any, issue_type: str | None = None) -> None:
        key = self.key(project, field_type, issue_type)
        self._cache.set(key, value, self._ttl)
        self.tracked.add(key)

    def clear(self, project: str, field_type: str | None = None) -> list[tuple]:
        """Forgets a project's lists, or those of one type of field."""
        head = ("lookup", project) + (() if field_type is None else (field_type,))
        gone = self._cache.invalidate(lambda k: k[: len(head)] == head)
        self.tracked = {k for k in self.tracked if k[: len(head)] != head}
        return gone

    def stats(self) -> dict[str, int]:
        """Tracked keys by project."""
        out: dict[str, int] = {}
        for k in self.tracked:
            out[k[1]] = out.get(k[1], 0) + 1
        return out


class ExpiringCache:
    """Values that are stale after one time and gone after another (four times that by default), with one refresh of a
    key at a time."""

    def __init__(self, clock: Callable[[], float] = time.monotonic, hard_factor: float = 4.0) -> None:
        self._clock, self._factor = clock, hard_factor
        self._values: dict[tuple, tuple[Any, float, float]] = {}
        self._locks: dict[tuple, threading.Lock] = {}
        self._guard = threading.Lock()

    def set(self, key: tuple, value: Any, ttl: float) -> None:
        now = self._clock()
        self._values[key] = (value, now + ttl, now + ttl * self._factor)

    def get(self, key: tuple, stale: bool = True) -> tuple[Any, bool] | None:
        """(value, is stale), or None."""
        found = self._values.get(key)
        if found is None:
            return None
        value, soft, hard = found
        now = self._clock()
        if now >= hard:
            self._values.pop(key, None)
            return None
        return None if now >= soft and not stale else (value, now >= soft)

    def refresh_once(self, key: tuple, make: Callable[[], Any], ttl: float) -> Any:
        """Callers that come while a refresh runs wait and get its value; errors go to the caller that refreshed."""
        with self._guard:
            lock = self._locks.setdefault(key, threading.Lock())
        waited = lock.locked()
        with lock:
            if waited and (found := self.get(key, stale=False)):
                return found[0]
            value = make()
            self.set(key, value, ttl)
            return value

    def invalidate(self, wanted: Callable[[tuple], bool] = lambda key: True) -> list[tuple]:
        gone = [k for k in self._values if wanted(k)]
        for k in gone:
            self._values.pop(k)
        return gone

    def __len__(self) -> int:
        return len(self._values)
