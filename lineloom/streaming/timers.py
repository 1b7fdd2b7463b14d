"""Job states with timers: an event moves its job once, and a job that doesn't move for some time comes out as stuck."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.jobs import FOLLOWS, allowed
from ..ship import ship
from .events import asked

#: The state store that timers and state with a time to live need (spark.sql.streaming.stateStore.providerClass).
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUT = "job_id string, status string, applied long, ignored long, stuck boolean"
HOUR = 3_600_000


class JobClock(StatefulProcessor):
    """The state of one job. Ids of events are kept for `remember` ms, so that what is delivered twice counts once; each event that
    leaves a job in a status of `watched` starts a timer of `idle` ms anew, and a job whose timer ends is given out as stuck."""

    def __init__(self, idle: int, remember: int, watched: tuple[str, ...]):
        self.idle, self.remember, self.watched = idle, remember, watched

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.job = handle.getValueState("job", "status string, applied long, ignored long")
        self.seen = handle.getMapState("seen", "event_id string", "n int", self.remember)

    def _was(self) -> tuple[str, int, int]:
        return tuple(self.job.get()) if self.job.exists() else ("Created", 0, 0)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        status, applied, ignored = self._was()
        new = pd.concat(list(rows)).sort_values(["timestamp", "event_id"])
        for event, ask in zip(new["event_id"], new["status"], strict=True):
            if event is not None and self.seen.containsKey((event,)):
                continue
            if event is not None:
                self.seen.updateValue((event,), (1,))
            if isinstance(ask, str) and allowed(status, ask):
                status, applied = ask, applied + 1
            else:
                ignored += 1
        self.job.update((status, applied, ignored))
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old if isinstance(old, int) else old[0])
        if status in self.watched:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle)
        yield self._row(key, status, applied, ignored, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield self._row(key, *self._was(), True)

    @staticmethod
    def _row(key, status, applied, ignored, stuck) -> pd.DataFrame:
        return pd.DataFrame({"job_id": [key[0]], "status": [status], "applied": [applied], "ignored": [ignored], "stuck": [stuck]})

    def close(self) -> None:
        pass


def clocked(events: DataFrame, idle: int = 2 * HOUR, remember: int = 24 * HOUR, watched: tuple[str, ...] = tuple(s for s, then in FOLLOWS.items() if then and s not in ("Failed", "On Hold", "Needs Password"))) -> DataFrame:
    """The state of each job that has new events, after them; and once more, with stuck, when nothing has come for `idle` ms.

    Statuses that wait for a person are not watched. Times are those of processing, so late events count, too. Needs the store STORE.
    """
    ship(events.sparkSession)
    own = asked(events).select("job_id", "event_id", "timestamp", "status")
    return own.groupBy("job_id").transformWithStateInPandas(JobClock(idle, remember, watched), OUT, "Update", "ProcessingTime")
