"""Mixing sources to target weights with DataFrame operations only.

Each source gets a share of a common budget by weight, never above a stated
number of epochs. Within a source the documents stand in a hash-random order;
distributed prefix sums over that order say how many words of each document
the mix takes, to the word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import WORD_PATTERN, fresh, materialize

WEIGHTS = (5, 2, 1)
BUDGET_PERCENT = 150
MAX_EPOCHS = 2
#: Rows that a range of hash keys has on average over all sources; a source's order is sorted range by range, so
#: even one that holds all rows spreads over as many tasks as they ask for.
RANGE_ROWS = 1 << 15


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def source_targets(totals: DataFrame, weights: tuple[int, ...], budget_percent: int, max_epochs: int) -> DataFrame:
    """Targets of (source, source_size): weights repeat over sources by code point, null last.

    The shares are a water level: in order of cap over weight, sources are held
    at their cap until what is left, dealt by weight, keeps every other one
    below its cap. One row per source enters the window.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_level = Window.orderBy("level", F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(by_name) - 1) % len(weights) + 1).cast("double")
    everything = Window.partitionBy()
    t = (
        totals.withColumn("weight", w)
        .withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
        .withColumn("level", F.col("cap") / F.col("weight"))
        .withColumn("budget", F.sum("source_size").over(everything) * F.lit(budget_percent / 100.0))
        .withColumn("before", F.coalesce(F.sum("cap").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("rest", F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("here", (F.col("budget") - F.col("before")) / F.col("rest"))
        .withColumn("place", F.row_number().over(by_level))
        .withColumn("water", F.min(F.when(F.col("level") >= F.col("here"), F.struct("place", "here"))).over(everything)["here"])
    )
    target = F.least("cap", F.coalesce(F.col("water"), F.col("level")) * F.col("weight"))
    return t.select("source", "source_size", target.alias("target"))


def mix_sources(
    df: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    weights: tuple[int, ...] = WEIGHTS,
    budget_percent: int = BUDGET_PERCENT,
    max_epochs: int = MAX_EPOCHS,
    range_rows: int = RANGE_ROWS,
    seed: int = 17,
) -> DataFrame:
    """One row per input row: doc_id, size, source_size, target, taken, row_key.

    Null text: size 0. A null source is a source of its own, last by name. A
    source without words has target 0. Rows equal in id and text share a hash
    key; ties are cut by id, then by size, and equal rows are interchangeable.
    An empty table gives an empty result. ``row_key`` ties a result to its row
    (with the id) where ids repeat.
    """
    sizes = df.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.col(f"`{source_col}`").alias("source"),
        word_count(F.col(f"`{text_col}`")).alias("size"),
        F.xxhash64(F.lit(seed), F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).alias("row_key"),
    )
    # The narrow table is read three times; the texts only once.
    sizes = materialize(sizes, "mix-sizes")
    bits = max(1, (sizes.count() // range_rows).bit_length())
    sizes = sizes.withColumn("rng", F.shiftright("row_key", 64 - bits))  # the leading bits: ranges in the order of keys
    ranged = sizes.groupBy("source", "rng").agg(F.sum("size").alias("range_size"))
    ranged = materialize(ranged, "mix-ranges")
    targets = source_targets(ranged.groupBy("source").agg(F.sum("range_size").alias("source_size")), weights, budget_percent, max_epochs)
    before = F.coalesce(F.sum("range_size").over(Window.partitionBy("source").orderBy("rng").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = (
        ranged.withColumn("range_before", before)
        .join(targets.withColumnRenamed("source", "src"), F.col("source").eqNullSafe(F.col("src")))
        .select(F.col("source").alias("o_source"), F.col("rng").alias("o_rng"), "range_before", "source_size", "target")
    )
    inside = Window.partitionBy("source", "rng").orderBy("row_key", F.col("doc_id").asc_nulls_last(), "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        sizes.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(offsets, F.col("source").eqNullSafe(F.col("o_source")) & (F.col("rng") == F.col("o_rng")))
        .withColumn("before", F.col("range_before") + F.col("inside"))
    )
    budget = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    left = budget - epochs * F.col("source_size")
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), left - F.col("before")))
    return placed.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"), "row_key", "source")


def mixed_documents(df: DataFrame, seed: int = 17, **options) -> DataFrame:
    """The mix itself, in the columns of ``documents``: whole copies, and a word prefix at a source's cut.

    Rows with nothing taken go. Null or empty texts have no words and take no
    part. The cut is the feature: it ends a source at its exact budget. Rows
    equal in id and text share their words evenly; words that can't be shared
    so, fewer than there are such rows, are left out. Further columns may have
    any names.
    """
    plan = mix_sources(df, seed=seed, **options)
    p_id, p_key, p_size, p_taken, p_rows, key, take = fresh(df, "p_id", "p_key", "p_size", "p_taken", "p_rows", "row_key", "n_take")
    takes = plan.select(F.col("doc_id").alias(p_id), F.col("row_key").alias(p_key), F.col("size").alias(p_size), "taken").filter("taken > 0")
    takes = takes.groupBy(p_id, p_key, p_size).agg(F.sum("taken").alias(p_taken), F.count(F.lit(1)).alias(p_rows))
    named = df.withColumn(key, F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text")))
    joined = named.join(takes, F.col("doc_id").eqNullSafe(F.col(p_id)) & (F.col(key) == F.col(p_key)))
    each = F.floor(F.col(p_taken) / F.col(p_rows))
    counts = F.transform(
        F.sequence(F.lit(1), F.ceil(each / F.col(p_size)).cast("int")),
        lambda i: F.least(F.col(p_size), each - (i - 1) * F.col(p_size)),
    )
    words = F.regexp_extract_all("text", F.lit("(" + WORD_PATTERN + ")"), F.lit(1))
    cut = F.when(F.col(take) == F.col(p_size), F.col("text")).otherwise(F.array_join(F.slice(words, 1, F.col(take).cast("int")), " "))
    out = joined.filter(each > 0).withColumn(take, F.explode(counts)).withColumn("text", cut)
    if "n_chars" in df.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast("long"))
    return out.select(*[F.col(f"`{c}`") for c in df.columns])
