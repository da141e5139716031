"""Running sums, maxima and last values over one global order, without a task that sees it all.

Rows are cut into ranges of the order and written with their range. Inside
a range a running value is a window; what stands before a range is the same
running value over one row a range, which is scanned alike while there are too
many of them for one task. Ranges have about ``rows`` rows whatever the keys
are: many rows at one instant are parted by the columns that break ties.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.storage import Tables

#: Rows of a range, and most ranges whose totals one task scans.
ROWS = 1 << 20


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that none of ``df``'s columns has, whatever the case of letters."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


class Ordered:
    """Rows of ``df`` in the order of ``by``, in ranges that are fixed because they are written. Rows equal in ``by`` follow each other in no set order."""

    def __init__(self, df: DataFrame, by: list[str], tables: Tables, rows: int = ROWS):
        self.by, self.tables, self.rows = by, tables, rows
        (self.range,) = fresh(df, "range_no")
        ranges = 1 + df.count() // rows
        cut = df.repartitionByRange(ranges, *[F.col(f"`{c}`") for c in by]) if ranges > 1 else df.coalesce(1)
        self.df = tables.write(cut.withColumn(self.range, F.spark_partition_id()), "ordered")

    def running(self, **values: tuple[str, Column]) -> Ordered:
        """Adds columns: ``name=(kind, value)`` with kind sum, max, last (value that is not null) or, without this row itself, before (the last one)."""
        (names, own) = (list(values), [f"{n}__{i}" for i, n in enumerate(values)])
        order, total = [F.col(f"`{c}`") for c in self.by], fresh(self.df, *own)
        window = Window.partitionBy(self.range).orderBy(*order)
        upto, ahead = window.rowsBetween(Window.unboundedPreceding, Window.currentRow), window.rowsBetween(Window.unboundedPreceding, -1)

        def inside(kind: str, value: Column) -> Column:
            if kind == "sum":
                return F.sum(value).over(upto)
            if kind == "max":
                return F.max(value).over(upto)
            return F.last(value, ignorenulls=True).over(upto if kind == "last" else ahead)

        def whole(kind: str, value: Column) -> Column:
            if kind in ("sum", "max"):
                return getattr(F, kind)(value)
            return F.max_by(value, F.when(value.isNotNull(), F.struct(*order)))

        kinds = [k for k, _ in values.values()]
        totals = self.df.groupBy(self.range).agg(*[whole(k, v).alias(t) for (k, v), t in zip(values.values(), total, strict=True)])
        before = self.before(totals, kinds, total)
        joined = self.df.join(before, self.range, "left")

        def both(kind: str, value: Column, t: str) -> Column:
            here, earlier = inside(kind, value), F.col(t)
            if kind == "sum":
                return F.coalesce(here, F.lit(0)) + F.coalesce(earlier, F.lit(0))
            return F.greatest(here, earlier) if kind == "max" else F.coalesce(here, earlier)

        out = joined.select(*[F.col(f"`{c}`") for c in self.df.columns], *[both(k, v, t).alias(n) for (k, v), t, n in zip(values.values(), total, names, strict=True)])
        new = object.__new__(Ordered)
        new.by, new.tables, new.rows, new.range = self.by, self.tables, self.rows, self.range
        new.df = self.tables.write(out, "scanned")
        return new

    def before(self, totals: DataFrame, kinds: list[str], names: list[str]) -> DataFrame:
        """Of each range, what stands before it."""
        totals = self.tables.write(totals, "totals")
        if totals.count() <= self.rows:
            ahead = Window.orderBy(self.range).rowsBetween(Window.unboundedPreceding, -1)
            over = lambda k, n: (F.sum(n) if k == "sum" else F.max(n) if k == "max" else F.last(n, ignorenulls=True)).over(ahead)
            return totals.select(self.range, *[over(k, n).alias(n) for k, n in zip(kinds, names, strict=True)])
        upper = Ordered(totals, [self.range], self.tables, self.rows)
        # Of the ranges up to this one; the next range's row takes it.
        scanned = upper.running(**{f"{n}_": (k if k in ("sum", "max") else "last", F.col(n)) for k, n in zip(kinds, names, strict=True)}).df
        return scanned.select((F.col(self.range) + 1).alias(self.range), *[F.col(f"{n}_").alias(n) for n in names])
