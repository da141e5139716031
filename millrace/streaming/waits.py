"""Waiting for tasks and batches on a stream of status records, with deadlines in event time.

Every task (or batch) is told of once: when the watermark has passed its end,
so that records that come out of order can't change what was told. Its
state is removed ``forget`` after its first record; until then it is known as told.
Tasks share states by shard, batches have one each.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.operators.status import TERMINAL

TIMEOUT = "TIMEOUT"
#: Groups of tasks. A checkpoint is good for one number of them.
SHARDS = 1024


def millis(us: int) -> int:
    """The first whole millisecond at or after an instant: timers know no smaller unit."""
    return -(-us // 1000)


class Waiter(StatefulProcessor):
    """Keeps one timer for each key: at the end of its wait, then at the end of its memory."""

    #: Columns of the key's own state beside its begin, its timer and whether it was told.
    facts = ""

    def __init__(self, timeout_us: int, forget_us: int):
        self.timeout_us, self.forget_us = timeout_us, forget_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("wait", "begin long, timer long, told boolean" + self.facts)

    def close(self) -> None:
        pass

    def remind(self, old: int | None, new: int) -> int:
        if old is not None and old != new:
            self.handle.deleteTimer(old)
        if old != new:
            self.handle.registerTimer(new)
        return new


class TaskWaiter(StatefulProcessor):
    """Keeps all tasks of a shard in one state, by columns, and one timer: at the first instant at which one of them is to be told of or forgotten."""

    def __init__(self, timeout_us: int, forget_us: int, kind: str):
        self.timeout_us, self.forget_us, self.kind = timeout_us, forget_us, kind

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("waits", f"timer long, task array<{self.kind}>, begin array<long>, ts array<long>, seq array<long>, state array<string>, told array<boolean>")

    def close(self) -> None:
        pass

    def known(self) -> tuple[int | None, dict[object, list]]:
        """The shard's timer, and begin, ts, seq, state and told of each task."""
        timer, tasks, *facts = self.state.get() or (None, [])
        return timer, dict(zip(tasks, map(list, zip(*facts, strict=True)), strict=True))

    def due(self, begin: int, ts: int | None, told: bool) -> int:
        """The timer of a task: at the end of its wait, then at the end of its memory."""
        if told:
            return millis(begin + self.forget_us)
        return millis(begin + self.timeout_us if ts is None else min(begin + self.timeout_us, ts))

    def keep(self, old: int | None, tasks: dict[object, list]) -> None:
        new = min((self.due(begin, ts, told) for begin, ts, _, _, told in tasks.values()), default=None)
        if old is not None and old != new:
            self.handle.deleteTimer(old)
        if new is None:
            self.state.clear()
            return
        if old != new:
            self.handle.registerTimer(new)
        self.state.update((new, list(tasks), *map(list, zip(*tasks.values(), strict=True))))

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        timer, tasks = self.known()
        for part in rows:
            for task, us, seq, state in zip(*(part[c].tolist() for c in ("task", "us", "seq", "state")), strict=True):
                mine = tasks.get(task)
                if mine is None:
                    mine = tasks[task] = [us, None, None, None, False]
                elif mine[4]:
                    continue
                mine[0] = min(mine[0], us)
                if state in TERMINAL and (mine[1] is None or (us, seq) < (mine[1], mine[2])):
                    mine[1:4] = us, seq, state
        self.keep(timer, tasks)
        return iter(())

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        now, ended = timerValues.getCurrentWatermarkInMs(), []
        kept = {}
        for task, (begin, ts, seq, state, told) in self.known()[1].items():
            if not told and self.due(begin, ts, told) <= now:
                deadline = begin + self.timeout_us
                done = ts is not None and ts <= deadline
                ended.append((task, begin, ts if done else deadline, state if done else TIMEOUT))
                ts, seq, state, told = None, None, None, True
            if not told or self.due(begin, ts, told) > now:
                kept[task] = [begin, ts, seq, state, told]
        self.keep(None, kept)  # the timer that expired is gone
        if ended:
            yield pd.DataFrame(ended, columns=["task", "begin_us", "end_us", "outcome"])


def task_outcomes(records: DataFrame, task: str, ts: str, seq: str, state: str, timeout_us: int, forget_us: int, late: str) -> DataFrame:
    """task, begin_us, end_us, outcome of each task of a stream of records, once.

    A wait begins with the task's first record. The first done or failed
    record within ``timeout_us`` is the outcome, else it is TIMEOUT at the
    deadline; of records at one instant the least ``seq`` counts, null last. Records that come
    more than ``late`` behind the newest one may be dropped; those of a task that
    was told of are, until ``forget_us`` after its first record: then one would
    begin another wait. Records without a task or a time are left out.

    Tasks are dealt to ``SHARDS`` by hash, each with one state and one timer: calls between
    Python and Spark follow the shards, not the tasks. A micro-batch reads and
    writes the states of the shards that it has rows of.
    """
    kept = records.select(F.col(task).alias("task"), F.col(ts).alias("ts"), F.unix_micros(ts).alias("us"), F.coalesce(F.col(seq).cast("long"), F.lit((1 << 63) - 1)).alias("seq"), F.col(state).alias("state"))
    kept = kept.filter("task is not null and ts is not null").withColumn("shard", F.pmod(F.xxhash64("task"), F.lit(SHARDS)).cast("int")).withWatermark("ts", late)
    kind = kept.schema["task"].dataType.simpleString()
    return kept.groupBy("shard").transformWithStateInPandas(TaskWaiter(timeout_us, forget_us, kind), f"task {kind}, begin_us long, end_us long, outcome string", "append", "EventTime")


class BatchWaiter(Waiter):
    facts = ", expected long"

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.items = handle.getMapState("items", "item string", "us long, seq long, state string, link boolean")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        begin, timer, told, expected = self.state.get() if self.state.exists() else (None, None, False, None)
        for part in rows:
            if told:
                continue
            begin = min(int(part["us"].min()), begin if begin is not None else 1 << 62)
            expected = max(int(part["expected"].max()), expected or 0)
            ends = part[part["state"].isin(TERMINAL)].sort_values(["us", "seq"]).drop_duplicates("item")
            for r in ends.itertuples():
                known = self.items.getValue((r.item,)) if self.items.containsKey((r.item,)) else None
                if known is None or (r.us, r.seq) < (known[0], known[1]):
                    self.items.updateValue((r.item,), (int(r.us), int(r.seq), r.state, bool(r.link)))
        if not told:
            ends = [v[0] for v in self.items.values()]
            deadline = begin + self.timeout_us
            timer = self.remind(timer, millis(min(deadline, max(ends)) if len(ends) >= expected else deadline))
            self.state.update((begin, timer, False, expected))
        return iter(())

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        begin, timer, told, expected = self.state.get()
        if told:
            self.state.clear()
            return
        deadline = begin + self.timeout_us
        items = [v for v in self.items.values() if v[0] <= deadline]
        whole = len(items) >= expected
        done = sum(v[2] == "done" and v[3] for v in items)
        end = max(v[0] for v in items) if whole else deadline
        self.items.clear()
        self.state.update((begin, self.remind(None, millis(begin + self.forget_us)), True, expected))
        yield pd.DataFrame({"batch": [key[0]], "begin_us": [begin], "end_us": [end], "outcome": ["DONE" if whole else TIMEOUT], "total": [expected], "done": [done], "failed": [len(items) - done], "active": [expected - len(items)]})


def batch_outcomes(records: DataFrame, batch: str, item: str, expected: str, ts: str, seq: str, state: str, link: str, timeout_us: int, forget_us: int, late: str) -> DataFrame:
    """batch, begin_us, end_us, outcome, total, done, failed, active of each batch of a stream of item records, once.

    A batch ends when all of the ``expected`` items (the greatest number its
    records name) are done or failed, each by its first such record; done needs a
    ``link``, else the item counts as failed. Without that within ``timeout_us`` of the
    batch's first record the outcome is TIMEOUT, with what ended by then. State
    is a row for each item that ended, as many as a batch has. For ``late`` and
    ``forget_us`` see ``task_outcomes``.
    """
    kept = records.select(F.col(batch).alias("batch"), F.col(item).cast("string").alias("item"), F.col(expected).cast("long").alias("expected"), F.col(ts).alias("ts"), F.unix_micros(ts).alias("us"), F.col(seq).cast("long").alias("seq"), F.col(state).alias("state"), F.coalesce(F.col(link), F.lit(False)).alias("link"))
    kept = kept.filter("batch is not null and item is not null and ts is not null and expected is not null").withWatermark("ts", late)
    kind = kept.schema["batch"].dataType.simpleString()
    return kept.groupBy("batch").transformWithStateInPandas(BatchWaiter(timeout_us, forget_us), f"batch {kind}, begin_us long, end_us long, outcome string, total long, done long, failed long, active long", "append", "EventTime")
