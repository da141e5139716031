"""Which of the requested artifacts may be served, decided for all requests at once against a table of files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import names

BAD_PATH, NOT_FOUND, TOO_LARGE = "ARTIFACT_BAD_PATH", "ARTIFACT_NOT_FOUND", "ARTIFACT_TOO_LARGE"


def steps(rel: Column) -> Column:
    """The steps of a relative path, either slash parting them; empty ones and single dots lead nowhere."""
    return F.filter(F.split(F.replace(rel, F.lit("\\"), F.lit("/")), "/"), lambda s: ~s.isin("", "."))


def entries(files: DataFrame, path: str = "path", size: str = "size") -> DataFrame:
    """key, size of every file (relative paths), and of every folder above one: its size is null."""
    s = steps(F.col(f"`{path}`"))
    own = files.select(F.array_join(s, "/").alias("key"), F.col(f"`{size}`").cast("long").alias("size"))
    above = F.transform(F.sequence(F.lit(1), F.size(s) - 1), lambda k: F.array_join(F.slice(s, F.lit(1), k), "/"))
    folders = files.filter(F.size(s) > 1).select(F.explode(above).alias("key"), F.lit(None).cast("long").alias("size"))
    # A file stated twice is one; partial aggregation leaves a row of each folder to a task before the shuffle.
    return own.filter("key is not null").unionAll(folders).groupBy("key").agg(F.max("size").alias("size"))


def served(requests: DataFrame, files: DataFrame, rel: str = "rel", most_bytes: int | None = None, path: str = "path", size: str = "size") -> DataFrame:
    """``requests`` with serve_key (the path under the root), serve_bytes and serve_error, null for what may be served.

    A path that is empty, has two dots running, begins with a slash or leads to
    the root itself is bad; a null one counts as empty. A folder is no file, so it isn't found.
    Columns with these names are replaced; a request that is stated twice is answered twice.
    """
    added = ("serve_key", "serve_bytes", "serve_error")
    kept = [F.col(f"`{c}`") for c in requests.columns if c.lower() not in added]
    r = F.coalesce(F.col(f"`{rel}`"), F.lit(""))
    key = F.when(names.servable(r), F.nullif(F.array_join(steps(r), "/"), F.lit("")))
    asked = requests.select(F.struct(*kept).alias("asked"), key.alias("serve_key"))
    there = entries(files, path, size).select(F.col("key").alias("serve_key"), F.col("size").alias("serve_bytes"))
    error = F.when(F.col("serve_key").isNull(), BAD_PATH).when(F.col("serve_bytes").isNull(), NOT_FOUND)
    if most_bytes:
        error = error.when(F.col("serve_bytes") > most_bytes, TOO_LARGE)
    return asked.join(there, "serve_key", "left").withColumn("serve_error", error).select("asked.*", *added)
