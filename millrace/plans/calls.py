"""Registered queries of calls: options, bodies, waiting, landing; and rules shown case by case, the driver-side submitter's among them.

The SQL of a rule is the table of its cases with the results written down from it.
"""

from __future__ import annotations

import json
import os
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.config import MODELS
from millrace.functions import names
from millrace.functions.dimensions import SUPPORTED
from millrace.operators import admission, archive, artifacts, limits, status
from millrace.plans.catalogue import LAND_SQL, STATE_SQL, demo_rows, landed, query, rule, table, task_records
from millrace.sources import files
from millrace.sources.service import Ledger, RateLimiter, ServiceError, Simulator, Submitter
from millrace.streaming import tasks


def sql_value(v: object) -> str:
    if v is None:
        return "null"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return str(v).lower() if isinstance(v, bool) else str(v)


def cases_sql(cases, columns: str, casts: str = "*") -> str:
    return f"select {casts} from (values {', '.join('(' + ', '.join(map(sql_value, c)) + ')' for c in cases)}) t({columns})"


#: url, valid, display name, file name that the light tier is told.
URL_CASES = (
    ("http://h/a/b.PDF?x=1#f", True, "b.PDF", "b.PDF"),
    ("HTTPS://user:pw@h:8080/a%20b.docx/", True, "a%20b.docx", "a%20b.docx"),
    ("http://h", True, "document", None),
    ("http://h?q=/z.pdf", True, "document", None),
    ("http://h/.pdf", True, ".pdf", None),
    ("https://h/x.tar.gz#y.pdf", True, "x.tar.gz", None),
    ("https://[::1]:443/p.html", True, "p.html", "p.html"),
    ("http://", False, None, None),
    ("http://?q", False, None, None),
    ("http://a b/c.pdf", False, None, None),
    ("http://h:99999/c.pdf", False, None, None),
    ("http://h:99999999999999999999999999/c.pdf", False, None, None),
    ("http://h:x/c.pdf", False, None, None),
    ("http://[::1/c.pdf", False, None, None),
    ("http://a<b>/c.pdf", False, None, None),
)


@rule(cases_sql([(u, "BAD_ARGS" if not ok else None, n, f) for u, ok, n, f in URL_CASES], "url, refusal, name, file_name"))
def url_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name and file name of URLs, or their refusal."""
    u = F.col("url")
    d = spark.createDataFrame([c[:1] for c in URL_CASES], "url string").withColumn("ok", names.valid_url(u)).withColumn("n", names.display_name(u))
    name = F.when(F.col("ok"), F.col("n"))
    return d.select("url", F.when(~F.col("ok"), "BAD_ARGS").alias("refusal"), name.alias("name"), F.when(names.extension(name).isin(*SUPPORTED), name).alias("file_name"))


#: call, place, source, length of the file (null: no regular file there), kind, place in its kind, refusal on the light tier.
SOURCE_CASES = (
    (1, 1, " /d/a.pdf ", 10, "file", 1, None),
    (1, 2, "", None, None, None, None),
    (1, 3, "https://h/b.pdf", None, "url", 1, None),
    (1, 4, "/d/none.pdf", None, "file", 2, "FILE_NOT_FOUND"),
    (1, 5, "/d/none.exe", None, "file", 3, "FILE_NOT_FOUND"),
    (1, 6, "/d/b.exe", 0, "file", 4, "UNSUPPORTED_TYPE"),
    (1, 7, "/d/b.html", 99999999, "file", 5, "AGENT_UNSUPPORTED"),
    (1, 8, "/d/c.pdf", 10485761, "file", 6, "TOO_LARGE"),
    (1, 9, "/d/d.pdf", 10485760, "file", 7, None),
    (1, 10, "/d/e.png", 0, "file", 8, "EMPTY_FILE"),
    (1, 11, "HTTP://h/c.html", None, "url", 2, "AGENT_UNSUPPORTED"),
    (1, 12, "http://h/plain", None, "url", 3, None),
    (1, 13, "/d/.pdf", 5, "file", 9, "UNSUPPORTED_TYPE"),
    (2, 1, "  ", None, None, None, None),
    (2, 2, "", None, None, None, None),
)


def source_rows(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    asked = spark.createDataFrame([c[:3] for c in SOURCE_CASES], "call long, ord long, source string")
    found = spark.createDataFrame([("file:" + c[2].strip(), c[3]) for c in SOURCE_CASES if c[3] is not None], "path string, length long")
    return asked, found


@rule(cases_sql([(c[0], c[1], c[2].strip(), *c[4:]) for c in SOURCE_CASES if c[4]], "call, ord, source, kind, rn, reason", "call::bigint as call, ord::bigint as ord, source, kind, rn::bigint as rn, reason"))
def source_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mixed sources of a call, parted by kind in their order, files looked up in a listing, first failure first."""
    asked, found = source_rows(spark)
    d = admission.classify(asked).withColumn("source", F.trim("source"))
    d = admission.chunk(d, ["call", "kind"], "ord", admission.chunk_limit(F.col("kind")))
    d = files.with_sizes(d, found)
    is_url, agent = F.col("kind") == "url", F.lit("agent")
    size = F.when(is_url, F.lit(1)).otherwise(F.col("size"))  # nothing is known of a URL's size
    return d.select("call", "ord", "source", "kind", "rn", admission.reason(agent, F.col("ext"), size, admission.size_limit(agent, F.lit(0)), is_url).alias("reason"))


@rule("select 2::bigint as call, 'BAD_ARGS' as refusal")
def blank_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return admission.empty_calls(source_rows(spark)[0])


OPTIONS_SQL = f"""with o as (select page_id, url,
  case when page_id % 2 = 0 then 'en' else 'ch' end as language, page_id % 3 <> 0 as enable_table, true as enable_formula, page_id % 4 = 1 as is_ocr,
  case page_id % 5 when 0 then 'vlm' when 1 then 'other' else 'pipeline' end as model_version,
  case when page_id % 6 = 0 then ['docx', 'html'] when page_id % 6 = 1 then ['latex'] else []::varchar[] end as extra_formats,
  case when page_id % 7 = 0 then 60000 else 600000 end as timeout_ms,
  case when page_id % 8 < 2 then '1-' || page_id % 8 when page_id % 8 = 2 then '' end as page_ranges,
  case when page_id % 9 = 0 then '2' end as page_range, 3000 as poll_interval_ms, 500 as poll_jitter_ms,
  case when page_id % 10 = 0 then 'id_' || page_id || '_' when page_id % 10 = 1 then null end as data_id from pages)
"""


def options(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("page_id")
    arg = F.struct(
        F.when(p % 2 == 0, "en").alias("language"),
        F.when(p % 3 == 0, F.lit(False)).alias("enable_table"),
        F.lit(None).cast("boolean").alias("enable_formula"),
        F.when(p % 4 == 1, F.lit(True)).alias("is_ocr"),
        F.when(p % 5 == 0, "vlm").when(p % 5 == 1, "other").alias("model_version"),
        F.when(p % 6 == 0, F.array(F.lit("docx"), F.lit("html"))).alias("extra_formats"),
        F.when(p % 7 == 0, F.lit(60000)).alias("timeout_ms"),
        F.when(p % 8 < 2, F.concat(F.lit("1-"), (p % 8).cast("string"))).when(p % 8 == 2, "").alias("page_ranges"),
        F.when(p % 9 == 0, "2").alias("page_range"),
        F.when(p % 10 == 0, F.concat(F.lit("id "), p.cast("string"), F.lit("é"))).when(p % 10 == 1, "").alias("data_id"),
    )
    cfg = F.struct(
        F.lit("ch").alias("language"), F.lit(True).alias("enable_table"), F.lit(True).alias("enable_formula"), F.lit(False).alias("is_ocr"), F.lit("pipeline").alias("model_version"),
        F.when(p % 6 == 1, F.array(F.lit("latex"))).alias("extra_formats"), F.lit(600000).alias("timeout_ms"), F.lit(3000).alias("poll_interval_ms"), F.lit(500).alias("poll_jitter_ms"),
    )
    return admission.call_options(table(spark, sf_dir, "pages").select("page_id", "url", arg.alias("arg"), cfg.alias("cfg")), MODELS).drop("arg", "cfg")


@query(OPTIONS_SQL + "select * exclude (extra_formats, url), array_to_string(extra_formats, ',') as extra_formats, case when model_version = 'other' then 'BAD_ARGS' end as refusal from o")
def resolved_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The call's options, else the session's; only null falls through."""
    return options(spark, sf_dir).withColumn("extra_formats", F.array_join("extra_formats", ",")).drop("url")


def json_sql(*pairs: tuple[str, str]) -> str:
    """SQL of an object's inside: each (key, SQL of its JSON value, null: left out)."""
    return "concat_ws(',', " + ", ".join(f"'\"{k}\":' || {v}" for k, v in pairs) + ")"


def text_sql(c: str) -> str:
    return f"'\"' || replace(replace({c}, chr(92), chr(92) || chr(92)), '\"', chr(92) || '\"') || '\"'"


_FLAGS = {c: f"cast({c} as varchar)" for c in ("is_ocr", "enable_formula", "enable_table")}
_LANG = ("language", text_sql("language"))
_EXTRA = ("extra_formats", "case when len(extra_formats) > 0 then '[\"' || array_to_string(extra_formats, '\",\"') || '\"]' end")
_RANGES = ("page_ranges", text_sql("nullif(page_ranges, '')"))
_SOLO = json_sql(("url", text_sql("url")), ("model_version", text_sql("model_version")), *_FLAGS.items(), _LANG, ("data_id", text_sql("data_id")), _RANGES, _EXTRA, ("no_cache", "'true'"))
_LIGHT = [_LANG, *((c, _FLAGS[c]) for c in ("enable_table", "is_ocr", "enable_formula")), ("page_range", text_sql("nullif(page_range, '')"))]


@query(OPTIONS_SQL + f"select page_id, '{{' || {_SOLO} || '}}' as precision_url, '{{' || {json_sql(('url', text_sql('url')), *_LIGHT)} || '}}' as light_url, '{{' || {json_sql(('file_name', text_sql(chr(39) + 'f ' + chr(39) + ' || page_id')), *_LIGHT)} || '}}' as light_file from o where model_version <> 'other'")
def request_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bodies of single requests; keys without a value are left out."""
    d = options(spark, sf_dir).filter("refusal is null").withColumn("file_name", F.concat(F.lit("f "), F.col("page_id").cast("string")))
    return d.select("page_id", admission.url_request(d).alias("precision_url"), admission.light_request("url").alias("light_url"), admission.light_request("file_name").alias("light_file"))


_ITEM = json_sql(("name", text_sql("'f ' || page_id")), ("data_id", text_sql("coalesce(data_id, 'doc-' || ((rn - 1) % 50 + 1))")), ("is_ocr", "cast(is_ocr as varchar)"), _RANGES)


@query(OPTIONS_SQL + f""", n as (select *, page_id // 1000 as call, row_number() over (partition by page_id // 1000 order by page_id) as rn from o)
select call, cast(floor((rn - 1) / 50) as bigint) as chunk_no, count(*) as n_items, '{{"files":[' || string_agg('{{' || {_ITEM} || '}}', ',' order by rn) || '],"model_version":"vlm","enable_formula":true,"enable_table":false,"language":"ch","extra_formats":["docx"]}}' as body from n group by 1, 2""")
def file_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bodies that ask for the upload links of file batches."""
    d = options(spark, sf_dir).withColumnRenamed("data_id", "own_id").drop("model_version", "enable_formula", "enable_table", "language", "extra_formats")
    d = d.select("*", F.lit("vlm").alias("model_version"), F.lit(True).alias("enable_formula"), F.lit(False).alias("enable_table"), F.lit("ch").alias("language"), F.array(F.lit("docx")).alias("extra_formats"))
    d = d.withColumn("call", admission.call_of(F.col("page_id"))).withColumn("name", F.concat(F.lit("f "), F.col("page_id").cast("string")))
    return admission.batch_bodies(admission.chunk(d, ["call"], "page_id", 50), ["call"], "name")


LABEL_CASES = (("precision", True, "precision"), ("precision", False, "precision-missing-token"), ("auto", True, "precision"), ("auto", False, "agent"), ("agent", True, "agent"), ("agent", False, "agent"), ("other", True, "agent"))


@rule(cases_sql(LABEL_CASES, "mode, has_token, label"))
def tier_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = spark.createDataFrame([c[:2] for c in LABEL_CASES], "mode string, has_token boolean")
    return d.select("*", admission.api_label(F.col("mode"), F.col("has_token")).alias("label"))


#: what is set, base URL of it, token of it, the header X of {X: base, Y: 1} merged with {X: what is set} (null: none given).
SETTING_CASES = (
    (" https://h/api// ", "https://h/api", "https://h/api//", " https://h/api// "),
    ("https://h", "https://h", "https://h", "https://h"),
    ("", "", None, ""),
    ("   ", "", None, "   "),
    ("/", "", "/", "/"),
    ("x" * 4096, "x" * 4096, "x" * 4096, "x" * 4096),
    ("x" * 4097, "x" * 4097, None, "x" * 4097),
)


@rule(cases_sql(SETTING_CASES, "given, base_url, token, header"))
def call_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base URLs without slashes at their end, usable tokens, and headers of which the later ones win."""
    g = F.col("given")
    merged = names.merged(F.create_map(F.lit("X"), F.lit("base"), F.lit("Y"), F.lit("1")), F.create_map(F.lit("X"), g))
    return spark.createDataFrame([c[:1] for c in SETTING_CASES], "given string").select("given", names.base_url(g).alias("base_url"), names.token(g).alias("token"), merged["X"].alias("header"))


#: name, external attributes, four bytes, whether it is a folder, their number.
ENTRY_CASES = (("a/", 0, "00000000", True, 0), ("a", 16, "01000000", True, 1), ("a", 48, "ffffffff", True, 4294967295), ("a", 32, "504b0304", False, 67324752), ("a/b", 0, "00000080", False, 2147483648))


@rule(cases_sql(ENTRY_CASES, "name, attr, raw, is_dir, number", "name, attr::bigint as attr, raw, is_dir, number::bigint as number"))
def entry_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = spark.createDataFrame([c[:3] for c in ENTRY_CASES], "name string, attr long, raw string")
    return d.select("*", names.is_directory(F.col("name"), F.col("attr")).alias("is_dir"), archive.unsigned32(F.unhex("raw")).alias("number"))


WAIT_SQL = "(case when event_id % 11 = 0 then null else event_id % 900 * 1000 end)"


@query(f"""with recursive d as (select event_id, {WAIT_SQL} as ends, 3000 + event_id % 500 as step from events),
p as (select event_id, ends, step, 0::bigint as passed, 1 as queries from d union all select event_id, ends, step, passed + step, queries + 1 from p where (ends is null or passed < ends) and passed + step <= 600000),
l as (select event_id, max(queries) as queries, max(passed) as passed, any_value(ends) as ends from p group by 1)
select event_id, case when ends is not null and passed >= ends then 'DONE' else 'TIMEOUT' end as outcome, queries::bigint as queries from l""")
def poll_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often a task is asked for and how waiting ends, from its duration, the interval with its jitter, and the deadline; the SQL polls step by step."""
    e = F.col("event_id")
    outcome, queries = limits.polled(F.when(e % 11 != 0, e % 900 * 1000), 3000 + e % 500, F.lit(600000))
    return table(spark, sf_dir, "events").select("event_id", outcome.alias("outcome"), queries.alias("queries"))


def shared_path(spark: SparkSession, tag: str) -> str:
    """A new path in the folder of ``spark.checkpoint.dir``; where that is unset, in a temporary one, on a local master only."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="millrace-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{tag}-{uuid.uuid4().hex}"


@query(LAND_SQL + "select call, rn, user_id, name, action, target from r where target is not null")
def run_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata of what landed, written as JSON lines by one job that commits all or nothing, and read again."""
    d = landed(spark, sf_dir).filter("target is not null").select("call", "rn", "user_id", "name", "action", "target")
    path = shared_path(spark, "runs")
    artifacts.write_run(d, path)
    return spark.read.schema(d.schema).json(path)


@query("select 'page-' || page_id || '.md' as name, strlen('# ' || url || chr(10))::bigint as bytes, '# ' || url as first_line from pages")
def markdown_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A text result of every page as a file under a usable name; the listing leaves out folders below."""
    texts = table(spark, sf_dir, "pages").select(names.file_name(F.concat(F.lit("/page-"), F.col("page_id").cast("string"), F.lit(".md"))).alias("name"), F.concat(F.lit("# "), "url", F.lit("\n")).alias("text"))
    path = shared_path(spark, "run")
    artifacts.write_texts(texts, path)
    artifacts.write_texts(texts.limit(1), path + "/images")
    listed = artifacts.listing(files.listing(spark, path))
    text = files.contents(spark, path).select(F.col("path").alias("p"), F.element_at(F.split(F.col("content").cast("string"), "\n"), 1).alias("first_line"))
    return listed.join(text, F.col("path") == F.col("p")).select("name", "bytes", "first_line")


#: archive, the text's first 24 bytes in hex, whether that is a part of it, its whole size, error.
TEXT_CASES = (
    ("good", (b"# Title\n" * 3).hex().upper(), True, 400, None),
    ("stored", b"text".hex().upper(), False, 4, None),
    ("bzip", "", False, 0, None),
    ("evil", None, None, None, "UNSAFE"),
    ("cut", None, None, None, "CORRUPT"),
    ("none", None, None, None, "CORRUPT"),
    ("flipped", (b"# Title\n" * 3).hex().upper(), True, 400, None),
)


@rule(cases_sql(TEXT_CASES, "archive, text, truncated, bytes, error", "archive, text, truncated, bytes::bigint as bytes, error"))
def zip_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main document of each archive up to 24 bytes; none: empty text."""
    d = spark.createDataFrame([(n, bytearray(b)) for n, b in demo_rows()], "archive string, content binary")
    return archive.main_texts(d, 24).select("archive", F.hex("text").alias("text"), "truncated", "bytes", "error")


@query(f"""with w as (select date_trunc('day', ts) as window_start, {STATE_SQL} as state, count(*) as n from events group by 1, 2)
select window_start, state, n from w where window_start + interval 1 day <= (select max(ts) - interval 1 hour from events)""")
def stream_state_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream over the events: records of each state a day, each day once the watermark has passed its end; run until the input is used up."""
    seen = table(spark, sf_dir, "events")
    stream = spark.readStream.schema(seen.schema).parquet(f"{sf_dir}/events.parquet*")
    kinds = F.col("event_type")
    state = F.when(kinds == "purchase", "done").when(kinds == "error", "failed").when(kinds == "view", "running").when(kinds == "click", "pending").otherwise("waiting-file")
    counts = tasks.state_counts(stream.select(F.col("ts").cast("timestamp").alias("ts"), state.alias("state")))
    path = shared_path(spark, "stream")
    run = counts.writeStream.outputMode("append").trigger(availableNow=True).option("checkpointLocation", path + "-state").format("parquet").start(path)
    run.awaitTermination()
    return spark.read.schema(counts.schema).parquet(path).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


class Flaky(Simulator):
    """The simulator, busy for the first ``busy`` requests, or slow."""

    busy, slow_s = 0, 0.0

    def submit(self, body: dict) -> str:
        if self.slow_s:
            time.sleep(self.slow_s)
        if self.busy > 0:
            self.busy -= 1
            raise ServiceError("429", retry_after="7")
        return super().submit(body)


#: scenario and what comes of it, by the rules of the service's client.
SERVICE_CASES = (
    ("a task is done at the second query", "done sim://task-1"),
    ("a task fails", "PARSE_FAILED simulated"),
    ("an unknown task", "-60012"),
    ("waiting beyond the deadline", "TIMEOUT"),
    ("busy twice", "task-1 after 14 s"),
    ("busy three times", "429"),
    ("a request hangs", "REQUEST_TIMEOUT"),
    ("201 URLs in a batch", "BATCH_TOO_LARGE"),
    ("51 files in a batch", "BATCH_TOO_LARGE"),
    ("files in a batch", "submitted,uploading a,uploading b,uploaded 1,22"),
    ("beyond the day's quota", "DAILY_LIMIT"),
    ("a new driver resumes", "task-1 task-2 1 new"),
    ("a result beyond the cap", "TOO_LARGE"),
    ("slower rate from now on", "0,30"),
)


def service_outcome(scenario: str) -> str:
    clock, slept = [0.0], []

    def sleep(s: float) -> None:
        slept.append(s)
        clock[0] += s

    service = Flaky()
    limiter = RateLimiter(60, 10**6, now=lambda: clock[0], sleep=sleep)
    sub = Submitter(service, limiter, 300, sleep=sleep)
    now = lambda: clock[0]
    try:
        match scenario:
            case "a task is done at the second query":
                got = sub.wait(sub.submit([("a", {})], "d")["a"], 3, 600, now)
                return f"{got['state']} {got['full_zip_url']}"
            case "a task fails":
                sub.wait(sub.submit([("a", {"fail": True})], "d")["a"], 3, 600, now)
            case "an unknown task":
                sub.wait("x", 3, 600, now)
            case "waiting beyond the deadline":
                service.polls = 10**6
                sub.wait(sub.submit([("a", {})], "d")["a"], 3, 600, now, 1)
            case "busy twice" | "busy three times":
                service.busy = 2 if scenario == "busy twice" else 3
                return f"{sub.submit([('a', {})], 'd')['a']} after {int(sum(slept))} s"
            case "a request hangs":
                service.slow_s, sub.request_timeout_s = 5, 0.05
                sub.submit([("a", {})], "d")
            case "201 URLs in a batch":
                sub.submit_urls("k", [{}] * 201, "d")
            case "51 files in a batch":
                sub.submit_files("k", [("a", b"")] * 51, "d")
            case "files in a batch":
                states: list[str] = []
                batch = sub.submit_files("k", [("a", b"1"), ("b", b"22")], "d", states.append)
                return ",".join(states) + " " + ",".join(service.fetch(f"sim://{batch}/{i}", 9).decode() for i in range(2))
            case "beyond the day's quota":
                sub.submit_urls("k", [{}] * 200, "d")
                sub.submit_urls("l", [{}] * 101, "d")
            case "a new driver resumes":
                path = os.path.join(tempfile.mkdtemp(), "ledger")
                sub.ledger = Ledger(path)
                sub.submit([("a", {})], "d")
                with open(path, "a") as f:
                    f.write(json.dumps({"b": "lost"})[:-3])  # the driver is lost while it writes
                again = Submitter(service, limiter, 300, Ledger(path), sleep=sleep)
                got = again.submit([("a", {}), ("b", {})], "d")
                return f"{got['a']} {got['b']} {again.used['d']} new"
            case "a result beyond the cap":
                service.results["x"] = b"12"
                service.fetch("sim://x", 1)
            case "slower rate from now on":
                limiter.reconfigure(2, 1)
                sub.submit([("a", {}), ("b", {})], "d")
                return f"0,{int(sum(slept))}"
    except ServiceError as x:
        return str(x) if x.code == "PARSE_FAILED" else x.code
    return "nothing"


@rule(cases_sql(SERVICE_CASES, "scenario, outcome"))
def service_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the submitter makes of the service's answers, played by the simulator on a clock that is set forward."""
    return spark.createDataFrame([(s, service_outcome(s)) for s, _ in SERVICE_CASES], "scenario string, outcome string")
