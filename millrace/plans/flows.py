"""Registered queries whose order matters over a whole table or a stream: one bucket for all, live rates, aborts, waits, commits."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.dimensions import SUPPORTED
from millrace.operators import admission, archive, limits, unpack
from millrace.operators.runs import RunStore
from millrace.plans.catalogue import DEMO_LIMITS, ITEMS_SQL, STATE_SQL, batch_items, query, quoted, table
from millrace.storage import shared_path
from millrace.streaming import run, waits
from millrace.streaming.ledger import Ledger

#: Tokens an hour and the bucket's size, so that submissions of the events at hand wait now and then.
HOUR_US, HOURLY, HELD = 3_600_000_000, 13, 4
#: Rows of a range: small, so that the tables at hand have many ranges.
RANGE_ROWS = 4096


def submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "event_type", "user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("t"))


@query(f"""with a as (select event_id, epoch_us(ts) as t, {HOURLY} * (epoch_us(ts) - (select min(epoch_us(ts)) from events)) as v, row_number() over (order by ts, event_id) as n from events),
b as (select *, max(v - n * {HOUR_US}::bigint) over (order by n rows unbounded preceding) + (n + 1) * {HOUR_US}::bigint as spent from a),
c as (select *, greatest(v, coalesce(lag(spent) over (order by n) - {HELD - 1} * {HOUR_US}::bigint, v)) as need from b)
select event_id, greatest(t, (select min(t) from a) + (need + {HOURLY - 1}) // {HOURLY}) - t as delay_us from c""")
def shared_throttle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All submissions through one bucket."""
    got = limits.shared_throttle(submissions(spark, sf_dir), "t", "event_id", initial=(HOURLY, HELD), period_us=HOUR_US, rows=RANGE_ROWS)
    return got.select("event_id", (F.col("release_us") - F.col("t")).alias("delay_us"))


@query(f"""with begin as (select min(epoch_us(ts)) as t0 from events where not (event_type = 'error' and event_id % 50 < 9)),
changes as (select t0 as t, 0 as later, {HOURLY}::bigint as rate, {HELD}::bigint as burst from begin
  union all select epoch_us(ts), 1, 8 + user_id % 9, 1 + user_id % 5 from events, begin where event_type = 'error' and event_id % 50 < 9 and epoch_us(ts) >= t0),
fills as (select *, coalesce(lag(rate) over w * (t - lag(t) over w), 0) as filled_by, coalesce(burst - lag(burst) over w, 0) as growth from changes window w as (order by t, later, rate, burst)),
segments as (select *, sum(filled_by) over (order by t, later, rate, burst rows unbounded preceding)::bigint as filled, row_number() over (order by t, later, rate, burst) as k from fills),
steps as (
  select null as event_id, t, 0 as kind, k, growth * {HOUR_US}::bigint as step, greatest(growth, 0) * {HOUR_US}::bigint as own, filled as now, burst from segments
  union all select event_id, e.t, 1, s.k, {HOUR_US}::bigint, {HOUR_US}::bigint, s.filled + s.rate * (e.t - s.t), s.burst
  from (select event_id, epoch_us(ts) as t from events where not (event_type = 'error' and event_id % 50 < 9)) e asof join (select * from segments qualify row_number() over (partition by t order by k desc) = 1) s on e.t >= s.t),
summed as (select *, sum(step) over (order by t, kind, k, event_id rows unbounded preceding)::bigint as a from steps),
spent as (select *, max(now + own - a) over (order by t, kind, k, event_id rows unbounded preceding) + a as x from summed),
paid as (select event_id, t, greatest(now, x - burst * {HOUR_US}::bigint) as need from spent where kind = 1)
select event_id, greatest(p.t, s.t + (need - s.filled + s.rate - 1) // s.rate) - p.t as delay_us
from paid p asof join (select * from segments qualify row_number() over (partition by filled order by k desc) = 1) s on p.need >= s.filled""")
def rate_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bucket whose rate and size change while submissions wait: some of the events are the changes."""
    e = submissions(spark, sf_dir)
    is_change = (F.col("event_type") == "error") & (F.col("event_id") % 50 < 9)
    rates = e.filter(is_change).select(F.col("t").alias("ts_us"), (F.col("user_id") % 9 + 8).alias("per_period"), (F.col("user_id") % 5 + 1).alias("burst"))
    got = limits.shared_throttle(e.filter(~is_change), "t", "event_id", rates, (HOURLY, HELD), HOUR_US, RANGE_ROWS)
    return got.select("event_id", (F.col("release_us") - F.col("t")).alias("delay_us"))


#: A wait's deadline, how late records may be, and how long a task that was told of is known.
TIMEOUT_US, LATE, FORGET_US = 6 * HOUR_US, "1 hour", 48 * HOUR_US


def record_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of the events as status records: a task is a user's day, a batch ten users' day."""
    seen = table(spark, sf_dir, "events")
    e = spark.readStream.schema(seen.schema).parquet(f"{sf_dir}/events.parquet*")
    kinds, day = F.col("event_type"), F.date_format("ts", "yyyy-MM-dd")
    state = F.when(kinds == "purchase", "done").when(kinds == "error", "failed").when(kinds == "view", "running").when(kinds == "click", "pending").otherwise("waiting-file")
    return e.select("event_id", F.col("ts").cast("timestamp").alias("ts"), state.alias("state"), F.concat(F.col("user_id").cast("string"), F.lit("@"), day).alias("task"), F.concat((F.col("event_id") % 40).cast("string"), F.lit("@"), day).alias("batch"), (F.col("event_id") % 3).alias("item"), F.lit(3).alias("expected"), (F.col("value") > 5).alias("link"))


def drained(stream: DataFrame, tag: str) -> DataFrame:
    """What a stream over a bounded input tells, written to the shared folder and read again."""
    spark, path = stream.sparkSession, shared_path(stream.sparkSession, tag)
    run.drain(stream, f"{path}/checkpoint", f"{path}/rows")
    return spark.read.schema(stream.schema).parquet(f"{path}/rows")


@query(f"""with r as (select user_id || '@' || strftime(ts, '%Y-%m-%d') as task, epoch_us(ts) as us, event_id, {STATE_SQL} as state from events),
b as (select task, min(us) as begin_us from r group by 1),
e as (select task, begin_us, r.us, r.state, row_number() over (partition by task order by us, event_id) as k from r join b using (task) where state in ('done', 'failed') and us <= begin_us + {TIMEOUT_US}::bigint),
o as (select b.task, b.begin_us, coalesce(us, b.begin_us + {TIMEOUT_US}::bigint) as end_us, coalesce(state, 'TIMEOUT') as outcome from b left join e on b.task = e.task and k = 1)
select * from o where end_us <= (select max(us) from r) - 3600000000""")
def wait_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the wait for each task of a stream ends: done, failed or at its deadline, each told once."""
    return drained(waits.task_outcomes(record_stream(spark, sf_dir), "task", "ts", "event_id", "state", TIMEOUT_US, FORGET_US, LATE), "waits")


@query(f"""with r as (select event_id % 40 || '@' || strftime(ts, '%Y-%m-%d') as batch, event_id % 3 as item, epoch_us(ts) as us, event_id, value > 5 as link, {STATE_SQL} as state from events),
b as (select batch, min(us) as begin_us from r group by 1),
e as (select batch, begin_us, item, us, state = 'done' and link as ok from r join b using (batch) where state in ('done', 'failed') and us <= begin_us + {TIMEOUT_US}::bigint qualify row_number() over (partition by batch, item order by us, event_id) = 1),
n as (select batch, count(*) as ended, count_if(ok) as done, max(us) as last_us from e group by 1),
o as (select batch, begin_us, case when ended = 3 then last_us else begin_us + {TIMEOUT_US}::bigint end as end_us, case when ended = 3 then 'DONE' else 'TIMEOUT' end as outcome,
  3::bigint as total, coalesce(done, 0)::bigint as done, (coalesce(ended, 0) - coalesce(done, 0))::bigint as failed, (3 - coalesce(ended, 0))::bigint as active from b left join n using (batch))
select * from o where end_us <= (select max(us) from r) - 3600000000""")
def batch_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When all items of each batch of a stream are done or failed, or that the deadline came first, each told once."""
    return drained(waits.batch_outcomes(record_stream(spark, sf_dir), "batch", "item", "expected", "ts", "event_id", "state", "link", TIMEOUT_US, FORGET_US, LATE), "batches")


@query("select distinct user_id || '@' || strftime(ts, '%Y-%m-%d') as task, 1::bigint as n_rows from events")
def resumed_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tasks of a stream, each taken into the ledger once, although the stream crashes half-way, comes again, and then loses its checkpoint."""
    path = shared_path(spark, "ledger")
    events = table(spark, sf_dir, "events")
    events.repartitionByRange(4, "ts").write.parquet(f"{path}/input")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/input")
    stream = stream.select("event_id", F.concat(F.col("user_id").cast("string"), F.lit("@"), F.date_format("ts", "yyyy-MM-dd")).alias("task"))
    ledger = Ledger(spark, f"{path}/ledger", "task string, event_id long", "task", "event_id")

    def crashing(batch: DataFrame, batch_id: int) -> None:
        ledger.take(batch, batch_id)
        if batch_id == 2:
            raise RuntimeError("crash after the batch was written and before it was committed")

    try:
        run.drain(stream, f"{path}/checkpoint", each=crashing)
    except StreamingQueryException:
        pass
    run.drain(stream, f"{path}/checkpoint", each=ledger.take)
    run.drain(stream, f"{path}/another-checkpoint", each=ledger.take)
    return ledger.rows().groupBy("task").agg(F.count(F.lit(1)).alias("n_rows"))


#: Pages a call, and lowered sizes of chunks, so that the pages at hand make calls of many chunks.
CALL_PAGES, CHUNKS = 100, {"url": 20, "file": 10}
ABORT_SQL = f"""with i as (select page_id, page_id // {CALL_PAGES} as call, case when page_id % 3 = 0 then 'url' else 'file' end as kind, case when page_id % 37 = 5 then '.exe' else '.html' end as ext, strlen(html) as size from pages),
g as (select *, case when kind = 'url' then null when ext not in ({quoted(SUPPORTED)}) then 'UNSUPPORTED_TYPE' when size > {DEMO_LIMITS["precision"]} then 'TOO_LARGE' when size = 0 then 'EMPTY_FILE' end as reason,
  (row_number() over (partition by call, kind order by page_id) - 1) // case when kind = 'url' then {CHUNKS["url"]} else {CHUNKS["file"]} end as chunk_no from i),
f as (select call, min(page_id) as failed_at, arg_min(chunk_no, page_id) as bad_chunk, arg_min(reason, page_id) as call_error from g where reason is not null group by 1),
o as (select page_id, g.call, kind, chunk_no::bigint as chunk_no, reason, case when failed_at is null or kind = 'url' or chunk_no < bad_chunk then 'SENT' when chunk_no > bad_chunk then 'NOT_SENT' when page_id = failed_at then 'REFUSED' else 'ABORTED' end as outcome, call_error, failed_at from g left join f on g.call = f.call)
"""


def aborted(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, kind = F.col("page_id"), F.when(F.col("page_id") % 3 == 0, "url").otherwise("file")
    d = table(spark, sf_dir, "pages").select("page_id", F.floor(n / CALL_PAGES).cast("long").alias("call"), kind.alias("kind"), F.when(n % 37 == 5, ".exe").otherwise(".html").alias("ext"), F.octet_length("html").cast("long").alias("size"))
    refusal = admission.reason(F.lit("precision"), F.col("ext"), F.col("size"), F.lit(DEMO_LIMITS["precision"]), F.col("kind") == "url")
    d = d.withColumn("reason", F.when(F.col("kind") == "file", refusal)).withColumn("is_file", F.col("kind") == "file")
    limit = F.when(F.col("kind") == "url", CHUNKS["url"]).otherwise(CHUNKS["file"])
    d = admission.chunk(d, ["call", "is_file"], "page_id", limit)
    return admission.ordered_abort(d, ["call"], ["is_file", "chunk_no"], "page_id", "reason")  # URLs go first


@query(ABORT_SQL + "select page_id, call, kind, chunk_no, reason, outcome, call_error, failed_at from o")
def ordered_abort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of each call went out before its first bad file stopped it."""
    return aborted(spark, sf_dir).select("page_id", "call", "kind", "chunk_no", "reason", "outcome", "call_error", "failed_at")


@query(ITEMS_SQL + ", " + ABORT_SQL.removeprefix("with ") + """select call, count(*) as n_items, count_if(outcome = 'SENT') as n_sent, count(distinct case when outcome = 'SENT' then kind || chunk_no end) as n_chunks_sent, max(call_error) as call_error,
  count_if(outcome = 'SENT' and call_error is null and s.state = 'done' and has_url) as n_landed, count_if(outcome = 'SENT' and call_error is null and not coalesce(s.state = 'done' and has_url, false)) as n_failed,
  case when max(call_error) is null then string_agg(page_id || ' ' || coalesce(s.state, 'unknown'), ', ' order by page_id) end as summary from o left join s on s.user_id = page_id % 150 group by 1""")
def batch_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch calls from end to end: gate, chunks, abort, the sent items' states, landing of calls that went through, and their summary."""
    states = batch_items(spark, sf_dir).select(F.col("user_id").alias("sim"), "state", "zip_url")
    d = aborted(spark, sf_dir).join(states, F.col("page_id") % 150 == F.col("sim"), "left")
    landed = F.coalesce((F.col("state") == "done") & F.col("zip_url").isNotNull(), F.lit(False))
    sent, whole = F.col("outcome") == "SENT", F.col("call_error").isNull()
    line = F.struct("page_id", F.concat_ws(" ", F.col("page_id").cast("string"), F.coalesce("state", F.lit("unknown"))).alias("line"))
    out = d.groupBy("call").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.count_if(sent).alias("n_sent"),
        F.count_distinct(F.when(sent, F.struct("kind", "chunk_no"))).alias("n_chunks_sent"),
        F.max("call_error").alias("call_error"),
        F.count_if(sent & whole & landed).alias("n_landed"),
        F.count_if(sent & whole & ~landed).alias("n_failed"),
        F.array_sort(F.collect_list(line)).alias("lines"),  # a call's items, of bounded number
    )
    return out.withColumn("summary", F.when(whole, F.array_join(F.transform("lines", lambda x: x["line"]), ", "))).drop("lines")


RUN_SQL = "with e as (select user_id || '@' || strftime(ts, '%Y-%m-%d') as run, event_id, length(props)::bigint as bytes, event_type = 'error' and event_id % 3 = 0 as bad from events)"


@query(RUN_SQL + " select run, count(*) as n_outputs, sum(bytes)::bigint as bytes, min(event_id) as first_output from e group by 1 having not bool_or(bad)")
def committed_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What readers see of runs of which some fail in an output, one attempt crashes before its commit and another commits twice."""
    e = table(spark, sf_dir, "events").select(F.concat(F.col("user_id").cast("string"), F.lit("@"), F.date_format("ts", "yyyy-MM-dd")).alias("run"), "event_id", F.char_length("props").cast("long").alias("bytes"), F.when((F.col("event_type") == "error") & (F.col("event_id") % 3 == 0), "COLLECT_FAILED").alias("error"))
    store = RunStore(spark, shared_path(spark, "store"), "run string, event_id long, bytes long, error string")
    store.stage(e)  # the crash: nothing names what was staged
    for _ in range(2):
        attempt = store.stage(e)
        store.commit(attempt)
        store.commit(attempt)
    store.vacuum()
    return store.outputs().groupBy("run").agg(F.count(F.lit(1)).alias("n_outputs"), F.sum("bytes").alias("bytes"), F.min("event_id").alias("first_output"))


#: Documents an archive; some archives are damaged: a byte of the first file, the end, or the name of the second file.
ARCHIVE_DOCS = 20
PACK_SQL = f"""with d as (select doc_id, doc_id // {ARCHIVE_DOCS} as archive, text, row_number() over (partition by doc_id // {ARCHIVE_DOCS} order by doc_id) - 1 as ordinal from documents where text is not null and doc_id >= 0),
a as (select archive, case archive % 7 when 2 then 'CORRUPT' when 4 then 'CORRUPT' when 5 then 'UNSAFE' end as error, case archive % 7 when 2 then 0 when 4 then -1 when 5 then 1 end as bad, count(*) as n from d group by 1)
"""


def packed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of the documents, written as a table; every seventh each is damaged in one of three ways."""
    n, a = F.col("doc_id"), F.col("archive")
    d = table(spark, sf_dir, "documents").filter("text is not null and doc_id >= 0").withColumn("archive", F.floor(n / ARCHIVE_DOCS).cast("long"))
    nth = F.pmod(n, F.lit(ARCHIVE_DOCS))
    evil = (a % 7 == 5) & (nth == 1)
    d = d.select("archive", "doc_id", F.when(evil, "../evil.md").otherwise(F.concat(F.lit("d/doc-"), n.cast("string"), F.lit(".md"))).alias("name"), F.col("text").cast("binary").alias("text"))
    zips = unpack.packed(d, "archive", "doc_id", "name", "text")
    c, size = F.col("content"), F.octet_length("content")
    flip = F.locate("PK\x01\x02", F.decode("content", "ISO-8859-1"))  # the directory; the checksum is 16 bytes on
    byte = F.unhex(F.lpad(F.hex(F.conv(F.hex(F.substr(c, flip + 16, F.lit(1))), 16, 10).cast("int").bitwiseXOR(F.lit(255))), 2, "0"))
    damaged = F.when(a % 7 == 2, F.concat(F.substr(c, F.lit(1), flip + 15), byte, F.substr(c, flip + 17))).when(a % 7 == 4, F.substr(c, F.lit(1), size - 30)).otherwise(c)
    path = shared_path(spark, "archives")
    zips.select("archive", damaged.alias("content")).write.parquet(path)
    return spark.read.schema("archive long, content binary").parquet(path)


@query(PACK_SQL + """select archive, ordinal::int as ordinal, 'd/doc-' || doc_id || '.md' as name, strlen(text)::bigint as size, sha256(text) as sha256, null as error from d join a using (archive) where error is null
union all select archive, bad::int, null, null, null, error from a""" + " where error is not null and n > 1 or bad <= 0")
def unpacked_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every file of the good archives of documents, and what is wrong with each of the others."""
    out = unpack.extract_all(packed_documents(spark, sf_dir), spark.sparkContext.defaultParallelism)
    return out.select("archive", "ordinal", "name", "size", F.sha2("content", 256).alias("sha256"), "error")


@query(PACK_SQL + """select archive, ordinal::int as ordinal, case when archive % 7 = 5 and doc_id % """ + str(ARCHIVE_DOCS) + """ = 1 then '../evil.md' else 'd/doc-' || doc_id || '.md' end as name, 8 as method, strlen(text)::bigint as size, null as error from d where archive % 7 <> 4
union all select archive, null, null, null, null, error from a where bad = -1""")
def archive_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The directories of archives of documents, or that there is none."""
    got = archive.scan(packed_documents(spark, sf_dir))
    return got.select("archive", "ordinal", "name", "method", F.col("uncompressed_size").alias("size"), "error")


MODES, CONFIGURED = ("null", "'auto'", "'precision'", "'agent'", "'odd'"), ("null", "'auto'", "'precision'", "'agent'")


@query(f"""with t as (select page_id, [{", ".join(MODES)}][page_id % 5 + 1] as mode, [{", ".join(CONFIGURED)}][page_id // 5 % 4 + 1] as cfg, page_id // 20 % 2 = 1 as has_token, case when page_id % 3 = 0 then '.html' else '.pdf' end as ext from pages),
a as (select *, coalesce(mode, cfg, 'auto') as asked from t)
select page_id, case when asked = 'precision' then case when has_token then 'precision' end when asked = 'agent' then 'agent' when has_token then 'precision' else 'agent' end as api,
  case when coalesce(mode, 'precision') = 'agent' or not has_token then null else 'precision' end as batch_api, case when ext = '.html' then 'html' else 'vlm' end as model from a""")
def page_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tier and model of every page, asked for in any way, with and without a token."""
    n = F.col("page_id")
    pick = lambda values, i: F.get(F.array(*[F.expr(v).cast("string") for v in values]), (i % len(values)).cast("int"))
    t = table(spark, sf_dir, "pages").select("page_id", pick(MODES, n).alias("mode"), pick(CONFIGURED, F.floor(n / 5)).alias("cfg"), (F.floor(n / 20) % 2 == 1).alias("has_token"), F.when(n % 3 == 0, ".html").otherwise(".pdf").alias("ext"))
    mode, cfg, token = F.col("mode"), F.col("cfg"), F.col("has_token")
    return t.select("page_id", admission.route(mode, cfg, token).alias("api"), admission.route_batch(mode, token).alias("batch_api"), admission.model_for(F.col("ext"), F.lit("vlm")).alias("model"))


STATUSES, HEADERS = (200, 401, 403, 404, 429, 500), ("null", "'5'", "'0'", "'500'", "'soon'")


@query(f"""with t as (select event_id, [{", ".join(map(str, STATUSES))}][event_id % 6 + 1] as status, event_id // 6 % 4 as attempt, [{", ".join(HEADERS)}][event_id // 24 % 5 + 1] as header from events)
select event_id, case when status = 429 then 'RATE_LIMITED' when status in (401, 403) then 'UNAUTHORIZED' when status between 200 and 299 then 'OK' else 'HTTP_ERROR' end as class,
  case when status = 429 and attempt < 2 then least(120, coalesce(nullif(try_cast(header as integer), 0), 30)) end as wait_s from t""")
def answer_retries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is made of the service's answer to each submission: its class, and how long to wait before the next try."""
    n = F.col("event_id")
    header = F.get(F.array(*[F.expr(h).cast("string") for h in HEADERS]), (F.floor(n / 24) % 5).cast("int"))
    status = F.get(F.array(*map(F.lit, STATUSES)), (n % 6).cast("int"))
    t = table(spark, sf_dir, "events").select("event_id", status.alias("status"), (F.floor(n / 6) % 4).cast("int").alias("attempt"), header.alias("header"))
    return t.select("event_id", limits.http_class(F.col("status")).alias("class"), limits.retry_wait(F.col("status"), F.col("attempt"), F.col("header")).alias("wait_s"))
