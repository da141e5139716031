"""Rates, quotas and retries as plans over submission times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.scans import ROWS, Ordered
from millrace.storage import Tables

RETRIES, DEFAULT_WAIT_S, MAX_WAIT_S = 2, 30, 120


def capacity(per_minute: int, burst: int | None = None) -> int:
    return max(1, burst if burst is not None else -(-per_minute // 5))


def throttle(df: DataFrame, by: list[str], ts_us: str, order: str, period_us: int, burst: int) -> DataFrame:
    """Release times of a token bucket that delays and never drops: one token every ``period_us``, ``burst`` at most.

    Closed form of the bucket: the theoretical arrival after request n is the
    running maximum of t(k) - k*T, plus (n+1)*T. ``by`` names the buckets.
    """
    w = Window.partitionBy(*by).orderBy(ts_us, order)
    seen = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = df.withColumn("n", F.row_number().over(w).cast("long"))
    d = d.withColumn("tat", F.max(F.col(ts_us) - F.col("n") * F.lit(period_us)).over(seen) + (F.col("n") + 1) * F.lit(period_us))
    before = F.lag("tat").over(w)
    return d.withColumn("release_us", F.coalesce(F.greatest(F.col(ts_us), before - F.lit((burst - 1) * period_us)), F.col(ts_us)))


def shared_throttle(df: DataFrame, ts_us: str, order: str, rates: DataFrame | None = None, initial: tuple[int, int] = (50, 10), period_us: int = 60_000_000, rows: int = ROWS) -> DataFrame:
    """Adds release_us: when one bucket that all rows share lets each through, in the order of ``ts_us``, ``order``.

    The bucket refills with ``per_period`` tokens every ``period_us`` and holds
    ``burst``, first as in ``initial``, later as the rows of ``rates`` (ts_us,
    per_period, burst) say: from its time on a new rate also serves those that
    wait, tokens stay, and what a smaller bucket can't hold is lost. At one instant
    a change comes before requests; of changes at one instant the greatest row is the last.
    A null time is that of the queue's begin.

    Work of the bucket is counted in tokens of refill since the queue began
    (``spent``): a request takes x, the work when its token is paid for, to
    max(x + 1, now + 1), a change of size to max(x + growth, now + growth, now). Such maps
    compose to maps of the same kind, so x is a running sum and a running
    maximum, each of which is scanned range by range; nothing is done in the
    queue's order by one task. All numbers are whole: a token is ``period_us`` units.
    Queues of up to 10**11 requests a minute's rate stay inside a long.
    """
    spark = df.sparkSession
    tables = Tables(spark)
    begin = df.agg(F.min(ts_us).alias("t")).first().t or 0
    changes = spark.createDataFrame([(begin, 0, *initial)], "ts_us long, later int, per_period int, burst int")
    if rates is not None:
        told = rates.select(F.coalesce("ts_us", F.lit(begin)).cast("long").alias("ts_us"), F.lit(1), F.col("per_period").cast("int"), F.col("burst").cast("int"))
        changes = changes.unionAll(told.filter(F.col("ts_us") >= begin))
    # The refill when each rate begins.
    r = Ordered(changes, ["ts_us", "later", "per_period", "burst"], tables, rows)
    r = r.running(was=("before", F.struct("ts_us", "per_period")))
    r = r.running(filled=("sum", F.coalesce(F.col("was.per_period").cast("long") * (F.col("ts_us") - F.col("was.ts_us")), F.lit(0))))
    segment = F.struct(F.col("ts_us").alias("begin"), "later", F.col("per_period").alias("rate"), "burst", "filled")
    asked = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.coalesce(F.col(f"`{ts_us}`"), F.lit(begin)).alias("t"), F.lit(1).alias("kind"), F.col(f"`{order}`").alias("o"), F.lit(None).cast(r.df.select(segment).schema[0].dataType).alias("segment"))
    told = r.df.select(F.lit(None).cast(asked.schema["row"].dataType).alias("row"), F.col("ts_us").alias("t"), F.lit(0).alias("kind"), F.lit(None).cast(asked.schema["o"].dataType).alias("o"), segment.alias("segment"))
    q = Ordered(asked.unionAll(told), ["t", "kind", "segment", "o"], tables, rows)
    q = q.running(now=("last", F.col("segment")), was=("before", F.col("segment")))
    token = F.lit(period_us)
    now = F.col("now.filled") + F.col("now.rate").cast("long") * (F.col("t") - F.col("now.begin"))
    step = F.when(F.col("kind") == 1, token.cast("long")).otherwise(F.coalesce(F.col("now.burst").cast("long") - F.col("was.burst"), F.lit(0)) * token)
    least = now + F.greatest(step, F.lit(0))
    q = q.running(steps=("sum", step))
    q = q.running(x=("max", least - F.col("steps")))
    spent = F.col("x") + F.col("steps")  # after this row
    start = F.greatest(now, spent - token - (F.col("now.burst").cast("long") - 1) * token)  # the refill at which its token is there
    paid = q.df.filter("kind = 1").select("row", "t", "o", start.alias("need"))
    # The instant of that refill: the last rate that begins with less.
    none = lambda d, c: F.lit(None).cast(d.schema[c].dataType).alias(c)
    paid = paid.select("need", F.lit(1).alias("kind"), "t", "o", "row", none(told, "segment"))
    begins = told.select(F.col("segment.filled").alias("need"), F.lit(0).alias("kind"), "t", none(asked, "o"), none(asked, "row"), "segment")
    upto = Ordered(paid.unionAll(begins), ["need", "kind", "t", "segment", "o"], tables, rows)
    upto = upto.running(now=("last", F.col("segment")))
    wait = F.expr("(need - now.filled + now.rate - 1) div now.rate")
    released = Tables(spark).write(upto.df.filter("kind = 1").select("row.*", F.greatest("t", F.col("now.begin") + wait).alias("release_us")), "released")
    tables.drop()
    return released


def daily_quota(df: DataFrame, day: str, slot: str, order: list[str], cost: str, limit: int) -> DataFrame:
    """Adds used and rejected. Rejected submissions stay counted.

    ``slot`` parts a day in the order of time (a minute, say): a day's running
    sum is its slots' sums before, and the sum inside the slot, so that no task
    gets a whole day.
    """
    sums = df.groupBy(day, slot).agg(F.sum(cost).alias("_sum"))
    earlier = Window.partitionBy(day).orderBy(slot).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col(day).alias("_day"), F.col(slot).alias("_slot"), F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(day, slot).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = df.withColumn("_inside", F.sum(cost).over(inside)).join(sums, F.col(day).eqNullSafe(F.col("_day")) & F.col(slot).eqNullSafe(F.col("_slot")))
    return placed.withColumn("used", F.col("_before") + F.col("_inside")).withColumn("rejected", F.col("used") > limit).drop("_before", "_inside", "_day", "_slot")


def polled(duration_ms: Column, interval_ms: Column, timeout_ms: Column) -> tuple[Column, Column]:
    """(outcome, queries) of waiting for a task that ends after ``duration_ms``, or never (null).

    The first query is made at once, the next ones ``interval_ms`` apart, and
    none later than ``timeout_ms``: the deadline is tested before each.
    """
    needed = F.when(duration_ms.isNotNull(), F.ceil(F.greatest(duration_ms, F.lit(0)) / interval_ms))  # greatest() skips nulls
    allowed = F.floor(timeout_ms / interval_ms)
    done = F.coalesce(needed <= allowed, F.lit(False))
    return F.when(done, "DONE").otherwise("TIMEOUT"), (F.when(done, needed).otherwise(allowed) + 1).cast("long")


def http_class(status: Column) -> Column:
    return F.when(status == 429, "RATE_LIMITED").when(status.isin(401, 403), "UNAUTHORIZED").when(status.between(200, 299), "OK").otherwise("HTTP_ERROR")


def retry_wait(status: Column, attempt: Column, retry_after: Column) -> Column:
    """Seconds to wait before the next try, null where there is none; attempts count from 0."""
    asked = F.try_to_number(F.when(retry_after.rlike(r"^[0-9]{1,9}$"), retry_after), F.lit("999999999")).cast("int")
    return F.when((status == 429) & (attempt < RETRIES), F.least(F.lit(MAX_WAIT_S), F.coalesce(F.nullif(asked, F.lit(0)), F.lit(DEFAULT_WAIT_S))))
