"""From sources to chunked requests: classify, gate, route, chunk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import names
from millrace.functions.dimensions import BATCH_LIMITS, CALL_LIMIT, LIGHT_UNSUPPORTED, SIZE_LIMITS, SUPPORTED
from millrace.operators.scans import fresh


def classify(df: DataFrame, source: str = "source") -> DataFrame:
    """Adds kind, name, ext of each source: URL facts from its path, file facts from its base name."""
    s = F.trim(F.col(source))
    base = F.regexp_extract(s, r"([^/]*)/*$", 1)
    return (
        df.filter(s != "")
        .withColumn("kind", F.when(names.is_url(s), "url").otherwise("file"))
        .withColumn("name", F.when(F.col("kind") == "url", names.display_name(s)).otherwise(base))
        .withColumn("ext", names.extension(F.col("name")))
    )


def size_limit(api: Column, cap: Column, limits: dict[str, int] = SIZE_LIMITS) -> Column:
    return F.coalesce(F.nullif(cap, F.lit(0)), F.when(api == "precision", limits["precision"]).otherwise(limits["agent"]))


def reason(api: Column, ext: Column, size: Column, limit: Column, is_url: Column | bool = False) -> Column:
    """Why a source is refused, first failure first; null: admitted. A missing size is a missing file.

    URLs without an extension are not refused for their type.
    """
    is_url = F.lit(is_url) if isinstance(is_url, bool) else is_url
    return (
        F.when(size.isNull(), "FILE_NOT_FOUND")
        .when(~ext.isin(*SUPPORTED) & ~(is_url & (ext == "")), "UNSUPPORTED_TYPE")
        .when((api == "agent") & ext.isin(*LIGHT_UNSUPPORTED), "AGENT_UNSUPPORTED")
        .when(size > limit, "TOO_LARGE")
        .when(size == 0, "EMPTY_FILE")
    )


def route(mode: Column, cfg_mode: Column, has_token: Column) -> Column:
    """The tier that serves a single call; null where the asked one needs a token. Unknown modes act as auto."""
    asked = F.coalesce(mode, cfg_mode, F.lit("auto"))
    return F.when(asked == "precision", F.when(has_token, "precision")).when(asked == "agent", "agent").otherwise(F.when(has_token, "precision").otherwise("agent"))


def api_label(cfg_mode: Column, has_token: Column) -> Column:
    """What a session says of its tier: one that asks for precision without a token says that the token is missing."""
    needy = (cfg_mode == "precision") & ~has_token
    return F.when(needy, "precision-missing-token").when(cfg_mode.isin("precision", "auto") & has_token, "precision").otherwise("agent")


def route_batch(mode: Column, has_token: Column) -> Column:
    """Batches run on the precision tier only; null: a token is needed."""
    return F.when((F.coalesce(mode, F.lit("precision")) == "agent") | ~has_token, None).otherwise("precision")


def model_for(ext: Column, model: Column) -> Column:
    return F.when(ext.isin(".html", ".htm"), "html").otherwise(model)


def resolve(df: DataFrame, options: tuple[str, ...], arg: str = "arg", cfg: str = "cfg") -> DataFrame:
    """Each option is the call's, else the session's; only null falls through."""
    return df.select("*", *(F.coalesce(F.col(f"{arg}.{o}"), F.col(f"{cfg}.{o}")).alias(o) for o in options))


#: What a call may set, what only a call sets, and what only the session sets.
CALL_OPTIONS = ("language", "enable_table", "enable_formula", "is_ocr", "model_version", "extra_formats", "timeout_ms")
ONLY_CALL, ONLY_SESSION = ("page_ranges", "page_range"), ("poll_interval_ms", "poll_jitter_ms")


def call_options(df: DataFrame, models: tuple[str, ...], arg: str = "arg", cfg: str = "cfg") -> DataFrame:
    """The options of each call from its ``arg`` and the session's ``cfg``; ``refusal`` where the model is none of ``models``.

    Languages are passed on as they are; extra formats default to none.
    """
    d = resolve(df, CALL_OPTIONS, arg, cfg)
    d = d.withColumn("extra_formats", F.coalesce("extra_formats", F.array().cast("array<string>")))
    d = d.select("*", *(F.col(f"{arg}.{o}").alias(o) for o in ONLY_CALL), *(F.col(f"{cfg}.{o}").alias(o) for o in ONLY_SESSION), names.data_id(F.col(f"{arg}.data_id")).alias("data_id"))
    return d.withColumn("refusal", F.when(~F.coalesce(F.col("model_version").isin(*models), F.lit(False)), "BAD_ARGS"))


def chunk(df: DataFrame, by: list[str], order: str, limit: Column | int, prefix: str = "doc") -> DataFrame:
    """Consecutive chunks inside each call. Adds rn, chunk_no, in_chunk and data_id.

    A call holds ``CALL_LIMIT`` sources at most, so the window's partitions are
    bounded; ``by`` must tell calls apart.
    """
    limit = F.lit(limit) if isinstance(limit, int) else limit
    return (
        df.withColumn("rn", F.row_number().over(Window.partitionBy(*by).orderBy(order)).cast("long"))
        .withColumn("chunk_no", F.floor((F.col("rn") - 1) / limit).cast("long"))
        .withColumn("in_chunk", (F.pmod(F.col("rn") - 1, limit) + 1).cast("long"))
        .withColumn("data_id", F.concat(F.lit(prefix + "-"), F.col("in_chunk").cast("string")))
    )


def ordered_abort(df: DataFrame, by: list[str], steps: list[str], order: str, reason: str) -> DataFrame:
    """Adds outcome, call_error and failed_at (the place, ``order``, of the first refusal) of each item of calls whose chunks go out one after the other.

    Chunks of a call, told apart and ordered by ``steps``, go out until one holds
    an item with a ``reason``: the chunks before it are SENT, the item is REFUSED,
    the others of its chunk are ABORTED, and what comes after is NOT_SENT. The
    call's error is the reason of its first refused item. A call is bounded
    (``CALL_LIMIT``), so its window is.
    """
    bad = F.struct(F.struct(*steps).alias("step"), F.col(order).alias("place"), F.col(reason).alias("reason"))
    first = F.min(F.when(F.col(reason).isNotNull(), bad)).over(Window.partitionBy(*by))
    (at,) = fresh(df, "first_bad")
    step, here = F.struct(*steps), F.col(at)
    outcome = (
        F.when(here.isNull() | (step < here["step"]), "SENT")
        .when(step > here["step"], "NOT_SENT")
        .when(F.col(order) == here["place"], "REFUSED")
        .otherwise("ABORTED")
    )
    return df.withColumn(at, first).withColumn("outcome", outcome).withColumn("call_error", here["reason"]).withColumn("failed_at", here["place"]).drop(at)


def chunk_limit(kind: Column) -> Column:
    return F.when(kind == "url", BATCH_LIMITS["url"]).otherwise(BATCH_LIMITS["file"])


def call_of(ordinal: Column) -> Column:
    return F.floor(ordinal / CALL_LIMIT).cast("long")


def url_request(df: DataFrame) -> Column:
    """The precision tier's body for one URL; null keys are left out."""
    extra = F.when(F.size("extra_formats") > 0, F.col("extra_formats"))
    fields = [F.col(c) for c in ("url", "model_version", "is_ocr", "enable_formula", "enable_table", "language")]
    return F.to_json(F.struct(*fields, names.data_id(F.col("data_id")).alias("data_id"), F.nullif(F.col("page_ranges"), F.lit("")).alias("page_ranges"), extra.alias("extra_formats"), F.lit(True).alias("no_cache")))


def light_request(source: str) -> Column:
    """The light tier's body for one source: a ``url``, or a ``file_name`` whose upload link is asked for."""
    fields = [F.col(c) for c in (source, "language", "enable_table", "is_ocr", "enable_formula")]
    return F.to_json(F.struct(*fields, F.nullif(F.col("page_range"), F.lit("")).alias("page_range")))


#: Options of a batch as a whole, in the order of the body.
BATCH_OPTIONS = ("model_version", "enable_formula", "enable_table", "language")


def batch_bodies(chunked: DataFrame, by: list[str], source: str) -> DataFrame:
    """One body per chunk: its items, each a ``source`` (url or name) with its own options, in order, then the call's options.

    The options of a call are the same in all of its rows. Items keep their own
    data id, made usable, or get that of their place in the chunk.
    """
    own = names.data_id(F.coalesce(F.col("own_id"), F.col("data_id"))).alias("data_id")
    item = F.struct(F.col(source), own, "is_ocr", F.nullif(F.col("page_ranges"), F.lit("")).alias("page_ranges"))
    d = chunked.groupBy(*by, "chunk_no").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.array_sort(F.collect_list(F.struct("in_chunk", item.alias("item")))).alias("items"),
        *(F.first(o).alias(o) for o in (*BATCH_OPTIONS, "extra_formats")),
    )
    extra = F.when(F.size("extra_formats") > 0, F.col("extra_formats")).alias("extra_formats")
    body = F.struct(F.transform("items", lambda x: x["item"]).alias("files"), *BATCH_OPTIONS, extra)
    return d.select(*by, "chunk_no", "n_items", F.to_json(body).alias("body"))


def empty_calls(df: DataFrame, call: str = "call", source: str = "source") -> DataFrame:
    """Calls of which no source is more than blanks, refused whole."""
    n = df.groupBy(call).agg(F.count_if(F.trim(source) != "").alias("n"))
    return n.filter("n = 0").select(call, F.lit("BAD_ARGS").alias("refusal"))


def refused_calls(df: DataFrame, call: str = "call", most: int = CALL_LIMIT) -> DataFrame:
    """call, n_items and the refusal of calls without sources for the service or with more than ``most``: a call is refused whole."""
    n = df.groupBy(call).agg(F.count(F.lit(1)).alias("n_items"))
    return n.filter(F.col("n_items") > most).select(call, "n_items", F.lit("BATCH_TOO_LARGE").alias("refusal"))


def forced_model(ext: Column, model: Column) -> Column:
    """Whether the extension changes the model that was asked for."""
    return model_for(ext, model) != model


def paired(df: DataFrame, items: str = "items", links: str = "links") -> DataFrame:
    """One row for each item with the upload link at the same place; the service answers in the order of the request."""
    return df.select("*", F.inline(F.arrays_zip(F.col(items).alias("item"), F.col(links).alias("link")))).drop(items, links)


def batch_requests(chunked: DataFrame, by: list[str]) -> DataFrame:
    """One body per chunk, items in order; a chunk has at most ``BATCH_LIMITS`` items."""
    item = F.struct("in_chunk", F.struct("url", "data_id").alias("item"))
    return chunked.groupBy(*by, "chunk_no").agg(F.count(F.lit(1)).alias("n_items"), F.to_json(F.struct(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["item"]).alias("files"))).alias("body"))
