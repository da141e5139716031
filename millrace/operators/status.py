"""Task and batch outcomes from status records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.dimensions import with_error_message

TERMINAL = ("done", "failed")
GENERIC = "The service answered with an error."


def latest(df: DataFrame, task: str, ts: str, tie: str, state: str) -> DataFrame:
    """The last state of each task and how many records it has; partial aggregation, no sort."""
    return df.groupBy(task).agg(F.max_by(state, F.struct(ts, tie)).alias("state"), F.count(F.lit(1)).alias("n_records")).withColumn("is_terminal", F.col("state").isin(*TERMINAL))


def batch_progress(items: DataFrame, batch: str, state: str = "state", url: str = "zip_url", expected: str | None = None) -> DataFrame:
    """Counts of each batch and whether it is complete. Done needs a result link; all else counts as failed.

    ``expected``, a column of the number submitted, also has to be reached where given.
    """
    done = (F.col(state) == "done") & F.col(url).isNotNull()
    active = ~F.coalesce(F.col(state), F.lit("unknown")).isin(*TERMINAL)
    aggs = [F.count(F.lit(1)).alias("total"), F.count_if(done).alias("done"), F.count_if(active).alias("active")]
    out = items.groupBy(batch).agg(*aggs, *([F.max(expected).alias("expected")] if expected else []))
    complete = (F.col("total") > 0) & (F.col("active") == 0)
    if expected:
        complete = complete & (F.col("total") >= F.col("expected"))
    return out.withColumn("failed", F.col("total") - F.col("done")).withColumn("is_complete", complete)


def payload_error(df: DataFrame, code: str = "code", err_code: str = "err_code", msg: str = "msg") -> DataFrame:
    """Adds error_message and raw_code: the code's message, else its detail's, else the text or the code itself."""
    d = with_error_message(with_error_message(df, F.col(code), "_outer"), F.col(err_code), "_inner")
    ok = F.coalesce(F.col(code).cast("string"), F.lit("0")) == "0"
    text = F.coalesce(F.nullif(F.col(msg), F.lit("")), F.col(code).cast("string"))
    message = F.when(~ok, F.coalesce("_outer", "_inner", text)).otherwise(F.coalesce("_inner", F.lit(GENERIC)))
    raw = F.when(~ok, F.col(code).cast("string")).otherwise(F.when(F.col("_inner").isNotNull(), F.col(err_code).cast("string")))
    return d.withColumn("error_message", message).withColumn("raw_code", raw).drop("_outer", "_inner")


def collect_action(state: Column, zip_url: Column, markdown_url: Column) -> Column:
    return F.when(F.coalesce(state, F.lit("unknown")) != "done", "NOT_DONE").when(zip_url.isNotNull(), "zip").when(markdown_url.isNotNull(), "markdown").otherwise("API")


def task_record(answer: Column) -> list[Column]:
    """The columns of a task's record from the service's answer (JSON); absent keys are null."""
    a = F.from_json(answer, "task_id string, state string, full_zip_url string, markdown_url string, err_msg string, err_code string, data_id string, file_name string, extract_progress struct<extracted_pages:int,total_pages:int>")
    names = {"task_id": "task_id", "state": "state", "full_zip_url": "zip_url", "markdown_url": "markdown_url", "err_msg": "error", "err_code": "error_code", "data_id": "data_id", "file_name": "file_name"}
    return [F.nullif(a[k], F.lit("")).alias(v) for k, v in names.items()] + [a["extract_progress"]["extracted_pages"].alias("pages_done"), a["extract_progress"]["total_pages"].alias("pages")]


def assembled(df: DataFrame, call: str = "call") -> DataFrame:
    """The result of each call: counts, and its items' names and outcomes as one line each, in their order."""
    line = F.concat_ws(" ", F.concat(F.col("rn").cast("string"), F.lit(".")), "name", F.coalesce("error", "target"))
    return (
        df.withColumn("line", line)
        .groupBy(call)
        .agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("error").isNull()).alias("landed"), F.array_sort(F.collect_list(F.struct("rn", "line"))).alias("lines"))
        .select(call, "total", "landed", F.array_join(F.transform("lines", lambda x: x["line"]), "\n").alias("summary"))
    )


def ordered(df: DataFrame, by: str, order: str, value: str, name: str) -> DataFrame:
    """Values of each group in order; groups are calls, of at most a thousand items."""
    return df.groupBy(by).agg(F.transform(F.array_sort(F.collect_list(F.struct(order, value))), lambda x: x[value]).alias(name))
