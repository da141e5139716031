"""Plans whose order matters: scans, one bucket for all, waits, aborts, ledger and commits, held against plain sequential code."""

import datetime
import random
from fractions import Fraction

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from millrace.operators import admission, limits
from millrace.operators.runs import RunStore
from millrace.operators.scans import Ordered
from millrace.storage import Tables
from millrace.streaming import run, waits
from millrace.streaming.ledger import Ledger


@pytest.mark.parametrize("rows", [3, 10, 1000])
def test_running_values_over_ranges(spark, rows):
    # Ranges of 3 rows: their totals are scanned in ranges of ranges.
    r = random.Random(rows)
    data = [(r.randrange(40), k, r.randrange(-9, 9), r.choice([None, r.randrange(99)])) for k in range(90)]
    tables = Tables(spark)
    q = Ordered(spark.createDataFrame(data, "t int, k int, x int, y int"), ["t", "k"], tables, rows)
    got = q.running(s=("sum", F.col("x")), m=("max", F.col("x")), last=("last", F.col("y")), was=("before", F.col("y"))).df.orderBy("t", "k").collect()
    s, m, last = 0, -99, None
    for row, (t, k, x, y) in zip(got, sorted(data, key=lambda d: d[:2]), strict=True):
        assert (row.t, row.k, row.was) == (t, k, last)
        s, m, last = s + x, max(m, x), y if y is not None else last
        assert (row.s, row.m, row.last) == (s, m, last)
    assert q.df.groupBy(q.range).count().agg(F.max("count")).first()[0] <= max(3 * rows, 90 if rows == 1000 else 0)
    tables.drop()


def bucket(requests, changes, initial, period):
    """Release times of a bucket that is refilled step by step, in exact fractions."""
    begin = min((t for t, _ in requests), default=0)
    changes = sorted(c for c in changes if c[0] >= begin)
    rate, size = initial
    tokens, now, out, queue = Fraction(size), begin, {}, sorted(requests)

    def refill(to):
        nonlocal tokens, now
        tokens, now = min(Fraction(size), tokens + Fraction(rate * (to - now), period)), to

    clock = Fraction(begin)
    for t, k in queue:
        clock = max(clock, Fraction(t))
        while True:
            due = changes[0][0] if changes else None
            if due is not None and due <= clock:
                refill(Fraction(due))
                _, rate, size = changes.pop(0)
                tokens = min(tokens, Fraction(size))
                continue
            if now < clock:
                refill(clock)
            if tokens >= 1:
                break
            ready = now + (1 - tokens) * period / rate
            if due is not None and due < ready:
                clock = Fraction(due)
                continue
            clock = ready
            tokens, now = Fraction(1), ready
        tokens -= 1
        out[k] = -(-clock.numerator // clock.denominator)
    return out


@pytest.mark.parametrize(("seed", "n_changes", "rows"), [(1, 0, 10**6), (2, 0, 7), (3, 4, 10**6), (4, 9, 11), (5, 30, 4)])
def test_shared_bucket_by_steps(spark, seed, n_changes, rows):
    r = random.Random(seed)
    requests = [(1000 + r.choice([r.randrange(4000), 1500, r.randrange(900, 1100)]), k) for k in range(150)]
    changes = [(r.randrange(500, 5200), r.randint(1, 40), r.randint(1, 9)) for _ in range(n_changes)]
    df = spark.createDataFrame([(*x, "kept") for x in requests], "t long, k long, row string")
    rates = spark.createDataFrame(changes, "ts_us long, per_period int, burst int") if changes else None
    got = limits.shared_throttle(df, "t", "k", rates, (20, 3), 1000, rows).collect()
    assert {x.k: x.release_us for x in got} == bucket(requests, changes, (20, 3), 1000)
    assert {x.row for x in got} == {"kept"}


def test_shared_bucket_without_requests(spark):
    assert limits.shared_throttle(spark.createDataFrame([], "t long, k long"), "t", "k").count() == 0


def at(us):
    return datetime.datetime(2024, 1, 1) + datetime.timedelta(microseconds=us)


SECOND = 1_000_000


def records(spark, tmp_path, parts, schema):
    """A stream of which every part is a micro-batch."""
    for k, part in enumerate(parts):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in/{k:02d}")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"file://{tmp_path}/in")


def test_task_waits_end_once_whatever_the_order(spark, tmp_path):
    r, rows = random.Random(5), []
    for task in range(30):
        begin = r.randrange(0, 60) * SECOND
        for _ in range(r.randint(1, 6)):
            rows.append((f"t{task}", at(begin + r.randrange(0, 25 * SECOND)), len(rows), r.choice(["pending", "running", "done", "failed", None])))
    rows += [(None, at(5), 900, "done"), ("t0", None, 901, "done"), ("last", at(500 * SECOND), 902, "pending")]
    # Parts in order of time, each a little mixed with the next: within what may be late.
    rows.sort(key=lambda x: (x[1] or at(0)) + datetime.timedelta(seconds=r.random() * 8))
    parts = [rows[i : i + 25] for i in range(0, len(rows), 25)]
    stream = records(spark, tmp_path, parts, "task string, ts timestamp, seq long, state string")
    out = waits.task_outcomes(stream, "task", "ts", "seq", "state", 10 * SECOND, 120 * SECOND, "30 seconds")
    run.drain(out, f"file://{tmp_path}/checkpoint", f"file://{tmp_path}/out")
    got = {x.task: (x.begin_us, x.end_us, x.outcome) for x in spark.read.parquet(f"file://{tmp_path}/out").collect()}
    epoch = int(at(0).replace(tzinfo=datetime.UTC).timestamp()) * SECOND
    expected = {}
    for task in {x[0] for x in rows if x[0] and x[1]} - {"last"}:
        mine = sorted(((x[1] - at(0)) // datetime.timedelta(microseconds=1) + epoch, x[2], x[3]) for x in rows if x[0] == task and x[1])
        begin = mine[0][0]
        end = next((m for m in mine if m[2] in ("done", "failed") and m[0] <= begin + 10 * SECOND), None)
        expected[task] = (begin, end[0], end[2]) if end else (begin, begin + 10 * SECOND, "TIMEOUT")
    assert got == expected and len(spark.read.parquet(f"file://{tmp_path}/out").collect()) == len(expected)


def test_task_waits_share_states_by_shard(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(waits, "SHARDS", 3)
    n = 200
    begin = lambda i: i % 50
    rows = [(f"t{i}", at(begin(i) * SECOND), None, "running") for i in range(n)]
    rows += [(f"t{i}", at((begin(i) + i % 19) * SECOND), None, "done") for i in range(n) if i % 19]
    rows += [(f"t{i}", at(99 * SECOND), None, "failed") for i in range(n)]  # told of by then
    rows += [("last", at(k * SECOND), None, "pending") for k in (400, 402)]
    rows.sort(key=lambda x: x[1])
    stream = records(spark, tmp_path, [rows[i : i + 70] for i in range(0, len(rows), 70)], "task string, ts timestamp, seq long, state string")
    out = waits.task_outcomes(stream, "task", "ts", "seq", "state", 10 * SECOND, 120 * SECOND, "5 seconds")
    run.drain(out, f"file://{tmp_path}/checkpoint", f"file://{tmp_path}/out")
    got = sorted((x.task, (x.end_us - x.begin_us) // SECOND, x.outcome) for x in spark.read.parquet(f"file://{tmp_path}/out").collect())
    assert got == sorted((f"t{i}", i % 19 if 0 < i % 19 <= 10 else 10, "done" if 0 < i % 19 <= 10 else "TIMEOUT") for i in range(n))
    state = spark.read.format("statestore").option("stateVarName", "waits").load(f"file://{tmp_path}/checkpoint")
    assert state.count() == 1  # "last"; all others are forgotten, and so are their shards


def test_batches_end_once(spark, tmp_path):
    row = lambda batch, item, us, state, link=True, expected=2: (batch, item, expected, at(us * SECOND), us, state, link)
    parts = [
        [row("whole", "a", 1, "running"), row("whole", "b", 3, "done"), row("cut", "a", 2, "done"), row("late", "a", 1, "failed")],
        [row("whole", "a", 2, "failed"), row("whole", "b", 4, "failed"), row("late", "b", 30, "done"), row("linkless", "a", 5, "done", None), row("linkless", "b", 6, "done")],
        [row("end", "a", 900, "pending")],
    ]
    stream = records(spark, tmp_path, parts, "batch string, item string, expected int, ts timestamp, seq long, state string, link boolean")
    out = waits.batch_outcomes(stream, "batch", "item", "expected", "ts", "seq", "state", "link", 10 * SECOND, 60 * SECOND, "40 seconds")
    run.drain(out, f"file://{tmp_path}/checkpoint", f"file://{tmp_path}/out")
    got = {x.batch: (x.outcome, (x.end_us - x.begin_us) // SECOND, x.total, x.done, x.failed, x.active) for x in spark.read.parquet(f"file://{tmp_path}/out").collect()}
    assert got == {"whole": ("DONE", 2, 2, 1, 1, 0), "cut": ("TIMEOUT", 10, 2, 1, 0, 1), "late": ("TIMEOUT", 10, 2, 0, 1, 1), "linkless": ("DONE", 1, 2, 1, 1, 0)}


def test_ledger_takes_every_id_once(spark, tmp_path):
    parts = [[(f"k{i % 7}", i) for i in range(n, n + 10)] for n in (0, 10, 20)] + [[(None, 99), ("new", 50), ("new", 40)]]
    stream = records(spark, tmp_path, parts, "id string, n long")
    ledger = Ledger(spark, f"file://{tmp_path}/ledger", "id string, n long", "id", "n")
    assert ledger.rows().count() == 0
    seen = []

    def crash(batch, batch_id):
        ledger.take(batch, batch_id)
        seen.append(batch_id)
        if batch_id == 1:
            raise RuntimeError("crash")

    with pytest.raises(StreamingQueryException):
        run.drain(stream, f"file://{tmp_path}/c1", each=crash)
    run.drain(stream, f"file://{tmp_path}/c1", each=ledger.take)
    run.drain(stream, f"file://{tmp_path}/c2", each=ledger.take)  # a lost checkpoint
    assert seen == [0, 1]
    rows = ledger.rows().collect()
    assert sorted(x.id for x in rows) == sorted([*(f"k{i}" for i in range(7)), "new"])
    assert next(x.n for x in rows if x.id == "new") == 40 and len({x.query for x in rows}) == 1


def test_abort_by_steps(spark):
    r = random.Random(8)
    items = [(call, k, r.choice([None] * 12 + ["TOO_LARGE", "EMPTY_FILE"])) for call in range(25) for k in range(r.randint(1, 30))]
    items += [(None, 0, "TOO_LARGE"), (None, 1, None)]
    df = admission.chunk(spark.createDataFrame([(*x, "kept") for x in items], "call int, k int, reason string, first_bad string"), ["call"], "k", 4)
    got = {(x.call, x.k): (x.outcome, x.call_error, x.first_bad) for x in admission.ordered_abort(df, ["call"], ["chunk_no"], "k", "reason").collect()}
    expected = {}
    for call in {x[0] for x in items}:
        mine, error = sorted(x[1:] for x in items if x[0] == call), None
        for lo in range(0, len(mine), 4):
            part, before = mine[lo : lo + 4], error
            bad = next((x for x in part if x[1]), None) if error is None else None
            for x in part:
                expected[call, x[0]] = "NOT_SENT" if before else "SENT" if bad is None else "REFUSED" if x is bad else "ABORTED"
            error = error or (bad and bad[1])
        expected |= {(call, x[0]): (expected[call, x[0]], error, "kept") for x in mine}
    assert got == expected


def test_runs_commit_whole_or_not_at_all(spark, tmp_path):
    store = RunStore(spark, f"file://{tmp_path}/store", "run string, name string, error string")
    assert store.outputs().count() == 0 and store.manifest().count() == 0 and store.vacuum() == []
    rows = spark.createDataFrame([("a", "x", None), ("a", "y", None), ("b", "x", None), ("b", "y", "CORRUPT"), (None, "z", None)], "run string, name string, error string")
    crashed = store.stage(rows)
    assert store.outputs().count() == 0
    first = store.stage(rows)
    store.commit(first)
    store.commit(first)
    again = store.stage(rows.filter("name = 'x'"))  # b's rerun is whole now; a is there already
    store.commit(again)
    assert sorted((x.run, x.name) for x in store.outputs().collect()) == [("a", "x"), ("a", "y"), ("b", "x")]
    assert store.vacuum() == [crashed] and store.outputs().count() == 3
