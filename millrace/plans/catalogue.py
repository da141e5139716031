"""All registered queries of the ingestion engine and the SQL that gives the same rows.

Inputs that the real engine gets from the service are simulated from the
driver's tables: ``events`` serve as submissions and as task records, ``pages``
as URL sources with the size of their HTML.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.config import Config
from millrace.functions import names
from millrace.functions.dimensions import ERRORS, INLINE, LIGHT_UNSUPPORTED, MIME, OTHER_MIME, SUPPORTED, error_table
from millrace.operators import admission, archive, artifacts, limits, status

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

#: Lowered so that every reason of the gate occurs in the tables at hand.
DEMO_LIMITS = {"precision": 12000, "agent": 6000}
TICK_US, BURST, DAY_LIMIT, PREVIEW = 600_000_000, 3, 100, 1000


def query(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


#: Rules shown case by case. They read no table, so they are not among the queries; tests hold them against their SQL.
RULES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
RULE_SQL: dict[str, str] = {}


def rule(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        RULES[f.__name__] = f
        if sql:
            RULE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def values(spark: SparkSession, rows: str, columns: str) -> DataFrame:
    return spark.sql(f"select * from values {rows} as t({columns})")


def quoted(items) -> str:
    return ", ".join("'" + i + "'" for i in items)


NAME_SQL = r"coalesce(nullif(regexp_extract(regexp_extract(url, '(?i)^https?://[^/?#]*([^?#]*)', 1), '([^/]*)/*$', 1), ''), 'document')"
EXT_SQL = r"lower(regexp_extract(name, '^.+(\.[^.]*)$', 1))"


@query(f"select page_id, kind, name, {EXT_SQL} as ext from (select page_id, case when regexp_matches(url, '(?i)^https?://') then 'url' else 'file' end as kind, {NAME_SQL} as name from pages)")
def source_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return admission.classify(table(spark, sf_dir, "pages").select("page_id", F.col("url").alias("source"))).select("page_id", "kind", "name", "ext")


GATED_SQL = f"""
with named as (select page_id, url, {NAME_SQL} as name, strlen(html) as size from pages),
typed as (select *, {EXT_SQL} as ext from named),
gated as (
  select page_id, api, name, ext, size, case when ext in ('.html', '.htm') then 'html' else 'vlm' end as model,
    case when ext <> '' and ext not in ({quoted(SUPPORTED)}) then 'UNSUPPORTED_TYPE'
         when api = 'agent' and ext in ({quoted(LIGHT_UNSUPPORTED)}) then 'AGENT_UNSUPPORTED'
         when size > case when api = 'precision' then {DEMO_LIMITS["precision"]} else {DEMO_LIMITS["agent"]} end then 'TOO_LARGE'
         when size = 0 then 'EMPTY_FILE' end as reason
  from typed, (values ('precision'), ('agent')) a(api))
"""


def gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Only the size of the HTML is needed; the two tiers are a projection, not a join.
    pages = table(spark, sf_dir, "pages").select("page_id", F.col("url").alias("source"), F.octet_length("html").cast("long").alias("size"))
    d = admission.classify(pages).withColumn("api", F.explode(F.array(F.lit("precision"), F.lit("agent"))))
    limit = admission.size_limit(F.col("api"), F.lit(0), DEMO_LIMITS)
    d = d.withColumn("reason", admission.reason(F.col("api"), F.col("ext"), F.col("size"), limit, F.col("kind") == "url"))
    return d.withColumn("model", admission.model_for(F.col("ext"), F.lit("vlm")))


@query(GATED_SQL + """, kept as (select page_id, api, cast(floor((row_number() over (partition by api, page_id // 1000 order by page_id) - 1) / 200) as bigint) as chunk_no from gated where reason is null)
select g.page_id, g.api, g.name, g.ext, g.size, g.model, g.reason, g.reason is null as admitted, k.chunk_no from gated g left join kept k on g.page_id = k.page_id and g.api = k.api""")
def admission_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tier, model, admission or its refusal, and chunk of every page on both tiers."""
    d = gated(spark, sf_dir).withColumn("call", admission.call_of(F.col("page_id"))).withColumn("admitted", F.col("reason").isNull())
    d = admission.chunk(d, ["api", "call", "admitted"], "page_id", admission.chunk_limit(F.col("kind")))
    return d.select("page_id", "api", "name", "ext", "size", "model", "reason", "admitted", F.when(F.col("admitted"), F.col("chunk_no")).alias("chunk_no"))


@query(GATED_SQL + "select api, coalesce(reason, 'ADMITTED') as outcome, count(*) as n, cast(sum(size) as bigint) as bytes from gated group by all")
def admission_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gated(spark, sf_dir).groupBy("api", F.coalesce("reason", F.lit("ADMITTED")).alias("outcome")).agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"))


ROUTE_VALUES = ", ".join(f"({m}, {c}, {t}, '{e}')" for m in ("null", "'auto'", "'precision'", "'agent'", "'odd'") for c in ("null", "'auto'", "'precision'", "'agent'") for t in ("true", "false") for e in (".html", ".pdf"))


@rule(f"""with t(mode, cfg, has_token, ext) as (values {ROUTE_VALUES}), a as (select *, coalesce(mode, cfg, 'auto') as asked from t)
select mode, cfg, has_token, ext,
  case when asked = 'precision' then case when has_token then 'precision' end when asked = 'agent' then 'agent' when has_token then 'precision' else 'agent' end as api,
  case when coalesce(mode, 'precision') = 'agent' or not has_token then null else 'precision' end as batch_api,
  case when ext in ('.html', '.htm') then 'html' else 'vlm' end as model from a""")
def api_route_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = values(spark, ROUTE_VALUES, "mode, cfg, has_token, ext")
    c = F.col
    return t.select("mode", "cfg", "has_token", "ext", admission.route(c("mode"), c("cfg"), c("has_token")).alias("api"), admission.route_batch(c("mode"), c("has_token")).alias("batch_api"), admission.model_for(c("ext"), F.lit("vlm")).alias("model"))


CHUNK_SQL = "select page_id, url, page_id // 1000 as call, row_number() over (partition by page_id // 1000 order by page_id) as rn from pages"


@query(f"select page_id, call, rn, cast(floor((rn - 1) / 50) as bigint) as chunk_no, 'doc-' || cast((rn - 1) % 50 + 1 as varchar) as data_id from ({CHUNK_SQL})")
def batch_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "pages").select("page_id").withColumn("call", admission.call_of(F.col("page_id")))
    return admission.chunk(d, ["call"], "page_id", 50).select("page_id", "call", "rn", "chunk_no", "data_id")


@query(f"select call, cast(floor((rn - 1) / 50) as bigint) as chunk_no, count(*) as n_items, string_agg(url, ' ' order by rn) as urls, string_agg('doc-' || cast((rn - 1) % 50 + 1 as varchar), ' ' order by rn) as data_ids from ({CHUNK_SQL}) group by 1, 2")
def batch_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bodies as JSON, read back into fields: JSON texts of two engines differ."""
    d = table(spark, sf_dir, "pages").select("page_id", "url").withColumn("call", admission.call_of(F.col("page_id")))
    bodies = admission.batch_requests(admission.chunk(d, ["call"], "page_id", 50), ["call"])
    files = F.from_json("body", "files array<struct<url string, data_id string>>")["files"]
    joined = lambda f: F.array_join(F.transform(files, lambda x: x[f]), " ")
    return bodies.select("call", "chunk_no", "n_items", joined("url").alias("urls"), joined("data_id").alias("data_ids"))


@query(f"select event_id, strftime(ts, '%Y-%m-%d') as day, cast(sum(user_id % 3 + 1) over w as bigint) as used, sum(user_id % 3 + 1) over w > {DAY_LIMIT} as rejected from events window w as (partition by strftime(ts, '%Y-%m-%d') order by ts, event_id rows unbounded preceding)")
def daily_quota(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "ts", names.utc_day(F.col("ts")).alias("day"), (F.col("user_id") % 3 + 1).alias("cost"))
    e = e.withColumn("minute", F.date_trunc("minute", "ts"))
    return limits.daily_quota(e, "day", "minute", ["ts", "event_id"], "cost", DAY_LIMIT).select("event_id", "day", "used", "rejected")


@query(f"""with a as (select event_id, user_id, epoch_us(ts) as t, row_number() over w as n from events window w as (partition by user_id order by ts, event_id)),
b as (select *, max(t - n * {TICK_US}) over (partition by user_id order by n rows unbounded preceding) + (n + 1) * {TICK_US} as tat from a)
select event_id, coalesce(greatest(t, lag(tat) over (partition by user_id order by n) - {(BURST - 1) * TICK_US}), t) - t as delay_us from b""")
def submit_throttle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's submissions through a bucket of its own, so that buckets are throttled in parallel."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("t"))
    return limits.throttle(e, ["user_id"], "t", "event_id", TICK_US, BURST).select("event_id", (F.col("release_us") - F.col("t")).alias("delay_us"))


RETRY_VALUES = ", ".join(f"({s}, {a}, {h})" for s in (200, 401, 403, 404, 429, 500) for a in range(4) for h in ("null", "'5'", "'0'", "'500'", "'soon'"))


@rule(f"""with t(status, attempt, header) as (values {RETRY_VALUES})
select status, attempt, header, case when status = 429 then 'RATE_LIMITED' when status in (401, 403) then 'UNAUTHORIZED' when status between 200 and 299 then 'OK' else 'HTTP_ERROR' end as class,
  case when status = 429 and attempt < 2 then least(120, coalesce(nullif(try_cast(header as integer), 0), 30)) end as wait_s from t""")
def retry_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = values(spark, RETRY_VALUES, "status, attempt, header")
    return t.select("status", "attempt", "header", limits.http_class(F.col("status")).alias("class"), limits.retry_wait(F.col("status"), F.col("attempt"), F.col("header")).alias("wait_s"))


CODES = sorted(ERRORS)
ERROR_VALUES = ", ".join(f"('{k}', '{v.replace(chr(39), chr(39) * 2)}')" for k, v in sorted(ERRORS.items()))
CODES_SQL = "[" + quoted(CODES) + "]"


@query(f"""with e(code, message) as (values {ERROR_VALUES}), t as (select event_id, cast(regexp_extract(props, '(\\d+)', 1) as bigint) as k from events where event_type = 'error'),
c as (select event_id, case when k % 3 = 0 then '0' when k % 3 = 1 then {CODES_SQL}[k % {len(CODES)} + 1] else 'E' || k end as code, case when k % 2 = 0 then {CODES_SQL}[(k + 7) % {len(CODES)} + 1] end as err_code, case when k % 5 > 0 then 'text ' || k else '' end as msg from t)
select event_id, case when c.code <> '0' then coalesce(o.message, i.message, nullif(msg, ''), c.code) else coalesce(i.message, '{status.GENERIC}') end as error_message,
  case when c.code <> '0' then c.code when i.message is not null then err_code end as raw_code
from c left join e o on c.code = o.code left join e i on c.err_code = i.code""")
def error_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").filter(F.col("event_type") == "error").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))
    codes = F.array(*map(F.lit, CODES))
    pick = lambda i: F.get(codes, F.pmod(i, F.lit(len(CODES))).cast("int"))
    k = F.col("k")
    d = e.select(
        "event_id",
        F.when(k % 3 == 0, "0").when(k % 3 == 1, pick(k)).otherwise(F.concat(F.lit("E"), k.cast("string"))).alias("code"),
        F.when(k % 2 == 0, pick(k + 7)).alias("err_code"),
        F.when(k % 5 > 0, F.concat(F.lit("text "), k.cast("string"))).otherwise("").alias("msg"),
    )
    return status.payload_error(d).select("event_id", "error_message", "raw_code")


STATE_SQL = "case event_type when 'purchase' then 'done' when 'error' then 'failed' when 'view' then 'running' when 'click' then 'pending' else 'waiting-file' end"


def task_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = F.col("event_type")
    state = F.when(kinds == "purchase", "done").when(kinds == "error", "failed").when(kinds == "view", "running").when(kinds == "click", "pending").otherwise("waiting-file")
    return table(spark, sf_dir, "events").select("event_id", "ts", "user_id", state.alias("state"), "value")


@query(f"select user_id as task_id, arg_max({STATE_SQL}, (ts, event_id)) as state, count(*) as n_records, arg_max({STATE_SQL}, (ts, event_id)) in ('done', 'failed') as is_terminal from events group by 1")
def task_latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status.latest(task_records(spark, sf_dir).withColumnRenamed("user_id", "task_id"), "task_id", "ts", "event_id", "state")


ITEMS_SQL = f"with s as (select user_id, arg_max({STATE_SQL}, (ts, event_id)) as state, arg_max(value, (ts, event_id)) > 5 as has_url, arg_max(value, (ts, event_id)) > 2 as has_text from events group by 1)"


def batch_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = F.struct("ts", "event_id")
    s = task_records(spark, sf_dir).groupBy("user_id").agg(F.max_by("state", last).alias("state"), F.max_by("value", last).alias("value"))
    return s.select(F.pmod("user_id", F.lit(10)).alias("batch_id"), "user_id", "state", F.when(F.col("value") > 5, "sim://zip").alias("zip_url"), F.when(F.col("value") > 2, "sim://text").alias("markdown_url"))


@query(ITEMS_SQL + " select user_id % 10 as batch_id, count(*) as total, cast(count_if(state = 'done' and has_url) as bigint) as done, cast(count_if(state not in ('done', 'failed')) as bigint) as active, cast(count(*) - count_if(state = 'done' and has_url) as bigint) as failed, count_if(state not in ('done', 'failed')) = 0 as is_complete from s group by 1")
def batch_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status.batch_progress(batch_items(spark, sf_dir), "batch_id")


@query(ITEMS_SQL + " select state, case when state <> 'done' then 'NOT_DONE' when has_url then 'zip' when has_text then 'markdown' else 'API' end as action, count(*) as n from s group by 1, 2")
def result_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = batch_items(spark, sf_dir)
    return d.groupBy("state", status.collect_action(F.col("state"), F.col("zip_url"), F.col("markdown_url")).alias("action")).agg(F.count(F.lit(1)).alias("n"))


@query(f"select doc_id, upper(hex(encode(text)[1:{PREVIEW}])) as prefix_hex, strlen(text) as bytes, strlen(text) > {PREVIEW} as truncated from documents")
def preview_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", F.hex(names.preview_prefix(t, PREVIEW)).alias("prefix_hex"), F.octet_length(t).cast("long").alias("bytes"), names.truncated(t, PREVIEW).alias("truncated"))


@query(f"select doc_id, text[1:list_max(list_filter(range(0, {PREVIEW + 1}), lambda k: strlen(text[1:k]) <= {PREVIEW}))] as preview from (select doc_id, text[1:{PREVIEW}] as text from documents)")
def preview_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole characters only."""
    return table(spark, sf_dir, "documents").select("doc_id", names.preview(F.col("text"), PREVIEW).alias("preview"))


SLUG_SQL = r"substr(regexp_replace(regexp_replace({0}, '[^A-Za-z0-9._\-]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, {1})"


@query(f"""select 'doc' as origin, doc_id as id, coalesce(nullif({SLUG_SQL.format("text", 80)}, ''), 'parse') as run_name, case when {SLUG_SQL.format("text", 120)} not in ('', '.', '..') then {SLUG_SQL.format("text", 120)} end as file_name from documents
union all select 'page', page_id, coalesce(nullif({SLUG_SQL.format("url", 80)}, ''), 'parse'), case when {SLUG_SQL.format("url", 120)} not in ('', '.', '..') then {SLUG_SQL.format("url", 120)} end from pages""")
def slug_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = table(spark, sf_dir, "documents").select(F.lit("doc").alias("origin"), F.col("doc_id").alias("id"), F.col("text").alias("s")).unionByName(table(spark, sf_dir, "pages").select(F.lit("page").alias("origin"), F.col("page_id").alias("id"), F.col("url").alias("s")))
    both = both.select("origin", "id", F.substring(names.dashed(F.col("s")), 1, 120).alias("d"))  # one pass over the text for both names
    return both.select("origin", "id", names.run_name_of(F.col("d")).alias("run_name"), names.file_name_of(F.col("d")).alias("file_name"))


@query(r"select page_id, nullif(substr(regexp_replace(url, '[^A-Za-z0-9_.\-]', '_', 'g'), 1, 128), '') as data_id from pages")
def data_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", names.data_id(F.col("url")).alias("data_id"))


@query("select doc_id, case when b <= 0 then 0.0::double when b < 1024 then b::double when b < 1048576 then round(b / 1024, 1) when b < 1073741824 then round(b / 1048576, 1) else round(b / 1073741824, 1) end as value, case when b < 1024 then 'B' when b < 1048576 then 'KB' when b < 1073741824 then 'MB' else 'GB' end as unit from (select doc_id, cast(strlen(text) as double) * (doc_id % 4) * 997 as b from documents)")
def format_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = F.octet_length("text").cast("double") * (F.col("doc_id") % 4) * 997
    value, unit = names.size_parts(b)
    return table(spark, sf_dir, "documents").select("doc_id", value.alias("value"), unit.alias("unit"))


FILE_EXTENSIONS = (".pdf", ".PDF", ".md", ".json", ".zip", ".tar.gz", ".htm", ".docx", ".doc", ".latex", "png", ".jp2", "", ".", ".svg", ".txt")
MIME_VALUES = ", ".join(f"('{k}', '{v}')" for k, v in sorted(MIME.items()))


@query(f"""with m(ext, mime) as (values {MIME_VALUES}), n as (select 'p' || page_id || x.e as name from pages, (values {", ".join(f"('{e}')" for e in FILE_EXTENSIONS)}) x(e)),
t as (select name, lower(name) as l, lower(regexp_extract(name, '(\\.[^.]*)$', 1)) as ext from n)
select name, t.ext, case when l like '%.md' then 'markdown' when l like '%.json' then 'json' when l like '%.zip' then 'zip' when regexp_matches(l, '.(png|jpe?g|jp2|webp|gif|bmp)$') then 'image' when regexp_matches(l, '\\.docx?$') then 'docx' when regexp_matches(l, '\\.html?$') then 'html' when regexp_matches(l, '\\.(tex|latex)$') then 'latex' else 'other' end as kind,
  coalesce(mime, '{OTHER_MIME}') as mime, t.ext in ({quoted(INLINE)}) as inline from t left join m on t.ext = m.ext""")
def artifact_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.explode(F.array(*map(F.lit, FILE_EXTENSIONS)))
    d = table(spark, sf_dir, "pages").select("page_id", e.alias("e")).select(F.concat(F.lit("p"), F.col("page_id").cast("string"), F.col("e")).alias("name"))
    return artifacts.describe(d).select("name", "ext", "kind", "mime", "inline")


ENTRY_NAMES = ("a/b.md", "./a//b", "../evil", "/abs", "C:/x", "a/../b", "", ".", "a/.", "dir/", "x..y", "images/p 1.png")
ENTRY_VALUES = ", ".join(f"('{n}')" for n in ENTRY_NAMES)


@rule(f"""with t(name) as (values {ENTRY_VALUES}), p as (select name, list_filter(string_split(name, '/'), lambda x: x not in ('', '.')) as parts from t)
select name, case when not regexp_matches(name, '^[A-Za-z]:|^/') and not list_contains(parts, '..') and len(parts) > 0 then array_to_string(parts, '/') end as safe, (name <> '' and not contains(name, '..') and not starts_with(name, '/')) as servable from p""")
def entry_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("name")
    return values(spark, ENTRY_VALUES, "name").select("name", names.entry_name(n).alias("safe"), names.servable(n).alias("servable"))


#: Values on both sides of every rule, and whether the rule lets them pass; written down from the rules, not computed by them.
CONFIG_CASES = (
    ("api_base_url", ("https://a.example", "HTTP://b"), ("ftp://a", "", "a.example")),
    ("token_credential", ("TOKEN", "_a1"), ("1a", "a-b", "")),
    ("mode", ("auto", "precision", "agent"), ("AUTO", "")),
    ("model_version", ("pipeline", "vlm", "html"), ("other",)),
    ("language", ("ch", "en"), ()),
    ("enable_table", (True, False), ()),
    ("enable_formula", (True, False), ()),
    ("is_ocr", (True, False), ()),
    ("extra_formats", ((), ("docx",), ("html", "latex")), (("pdf",),)),
    ("expose_mode", ("progressive", "always"), ("never",)),
    ("artifact_root_name", (".artifacts", "out"), ("", ".", "..", "a/b", "a\\b")),
    ("poll_interval_ms", (500, 60000), (499, 60001, True)),
    ("poll_jitter_ms", (0, 10000), (-1, 10001)),
    ("timeout_ms", (10000, 3600000), (9999, 3600001)),
    ("max_file_bytes", (0, 536870912), (-1, 536870913)),
    ("inline_markdown_bytes", (256, 1048576), (255, 1048577)),
    ("artifact_url_ttl_sec", (60, 2592000), (59, 2592001)),
    ("submit_rate_per_min", (1, 60), (0, 61)),
    ("poll_rate_per_min", (10, 1000), (9, 1001)),
    ("daily_submit_limit", (1, 100000), (0, 100001)),
    ("user_agent", ("x",), ()),
)
CONFIG_ROWS = [(option, str(i), v, ok) for option, good, bad in CONFIG_CASES for i, (v, ok) in enumerate([*((g, True) for g in good), *((x, False) for x in bad)])]


@rule("select * from (values " + ", ".join(f"('{o}', '{i}', {str(ok).lower()})" for o, i, _, ok in CONFIG_ROWS) + ") t(option, case_no, valid)")
def config_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the validator says of every option's values."""
    rows = [(o, i, o not in Config(**{o: v}).problems()) for o, i, v, _ in CONFIG_ROWS]
    return spark.createDataFrame(rows, "option string, case_no string, valid boolean")


PARSE_OPTIONS = ("vlm", 25)  # the model asked for, and the sources of a demonstration call


@query(GATED_SQL + f"""select page_id, page_id // {PARSE_OPTIONS[1]} as call, name, api, model, model <> '{PARSE_OPTIONS[0]}' as forced, reason,
  case when reason is null then api || case when model <> '{PARSE_OPTIONS[0]}' then ': ' || ext || ' needs the model ' || model else '' end else 'refused: ' || reason end as line from gated""")
def plan_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Single parses of all pages on both tiers: tier, model, whether the extension forced it, refusal, and the line that says so."""
    d = gated(spark, sf_dir)
    asked = F.lit(PARSE_OPTIONS[0])
    forced = admission.forced_model(F.col("ext"), asked)
    warning = F.when(forced, F.concat(F.lit(": "), "ext", F.lit(" needs the model "), "model")).otherwise("")
    line = F.when(F.col("reason").isNull(), F.concat("api", warning)).otherwise(F.concat(F.lit("refused: "), "reason"))
    return d.select("page_id", F.floor(F.col("page_id") / PARSE_OPTIONS[1]).alias("call"), "name", "api", "model", forced.alias("forced"), "reason", line.alias("line"))


@query("select user_id as call, count(*) as n_items, 'BATCH_TOO_LARGE' as refusal from events group by 1 having count(*) > 12")
def batch_refusals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls with more sources than allowed (lowered to 12 here) are refused whole."""
    return admission.refused_calls(table(spark, sf_dir, "events").select(F.col("user_id").alias("call")), "call", 12)


@query(f"select call, chunk_no, 'doc-' || cast((rn - 1) % 50 + 1 as varchar) as item, 'sim://' || call || '/' || chunk_no || '/' || ((rn - 1) % 50) as link from (select *, cast(floor((rn - 1) / 50) as bigint) as chunk_no from ({CHUNK_SQL}))")
def upload_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of file batches with the upload link at the same place of the service's answer."""
    d = table(spark, sf_dir, "pages").select("page_id").withColumn("call", admission.call_of(F.col("page_id")))
    d = admission.chunk(d, ["call"], "page_id", 50).groupBy("call", "chunk_no").agg(F.transform(F.array_sort(F.collect_list(F.struct("in_chunk", "data_id"))), lambda x: x["data_id"]).alias("items"))
    base = F.concat(F.lit("sim://"), F.col("call").cast("string"), F.lit("/"), F.col("chunk_no").cast("string"), F.lit("/"))
    links = F.transform(F.sequence(F.lit(0), F.size("items") - 1), lambda i: F.concat(base, i.cast("string")))  # what the simulator answers
    return admission.paired(d.withColumn("links", links))


@query(f"""with s as (select event_id, {STATE_SQL} as state, value from events)
select 'task-' || event_id as task_id, state, case when state = 'done' then 'sim://zip/' || event_id end as zip_url, cast(null as varchar) as markdown_url, case when state = 'failed' then 'simulated' end as error,
  cast(null as varchar) as error_code, cast(null as varchar) as data_id, cast(null as varchar) as file_name, case when state = 'running' then cast(event_id % 7 as integer) end as pages_done, case when state = 'running' then 7 end as pages from s""")
def task_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of tasks from the service's JSON answers; empty strings and absent keys are null."""
    d = task_records(spark, sf_dir)
    running = F.col("state") == "running"
    answer = F.to_json(F.struct(
        F.concat(F.lit("task-"), "event_id").alias("task_id"), "state",
        F.when(F.col("state") == "done", F.concat(F.lit("sim://zip/"), "event_id")).otherwise("").alias("full_zip_url"),
        F.when(F.col("state") == "failed", "simulated").alias("err_msg"),
        F.when(running, F.struct((F.col("event_id") % 7).cast("int").alias("extracted_pages"), F.lit(7).alias("total_pages"))).alias("extract_progress"),
    ))
    return d.select(answer.alias("answer")).select(*status.task_record(F.col("answer")))


LAND_SQL = ITEMS_SQL.replace("select user_id,", "select user_id, max(ts) as ended,") + """, n as (select user_id, user_id % 10 as call, row_number() over (partition by user_id % 10 order by user_id) as rn, 'item ' || user_id as name, ended, state, case when state <> 'done' then 'NOT_DONE' when has_url then 'zip' when has_text then 'markdown' else 'API' end as action from s),
r as (select *, case when action in ('zip', 'markdown') then 'item-' || user_id || '_' || strftime(ended, '%Y%m%d-%H%M%S') || '_' || substr(md5(cast(user_id as varchar)), 1, 4) || '/full.md' end as target from n)
"""


def landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = F.struct("ts", "event_id")
    d = task_records(spark, sf_dir).groupBy("user_id").agg(F.max_by("state", last).alias("state"), F.max_by("value", last).alias("value"), F.max("ts").alias("ended"))
    d = d.withColumn("call", F.col("user_id") % 10).withColumn("name", F.concat(F.lit("item "), "user_id"))
    d = admission.chunk(d, ["call"], "user_id", 1000)
    action = status.collect_action(F.col("state"), F.when(F.col("value") > 5, "sim://zip"), F.when(F.col("value") > 2, "sim://text"))
    run = names.run_id(F.col("name"), F.col("ended"), F.md5(F.col("user_id").cast("string")))
    got = action.isin("zip", "markdown")
    return d.select("call", "rn", "user_id", "name", action.alias("action"), F.when(~got, action).alias("error"), F.when(got, F.concat(run, F.lit("/full.md"))).alias("target"))


@query(LAND_SQL + "select call, rn, user_id, name, action, case when target is null then action end as error, target from r")
def land_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every item's text lands: a run folder of its own, or why it does not."""
    return landed(spark, sf_dir)


@query(LAND_SQL + """select call, count(*) as total, cast(count(target) as bigint) as landed, string_agg(rn || '. ' || name || ' ' || coalesce(target, action), chr(10) order by rn) as summary from r group by 1""")
def call_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of each call, its items in order."""
    return status.assembled(landed(spark, sf_dir))


#: The checksum's table from its polynomial, and the checksum byte by byte.
CRC_SQL = """with tab as (select list(c order by i) as t from (select i, list_reduce(list_prepend(i::bigint, range(8)), lambda c, k: case when c % 2 = 1 then xor(c >> 1, 3988292384::bigint) else c >> 1 end) as c from range(256) r(i))),
b as (select doc_id, strlen(text) as bytes, list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda x: ('0x' || x)::bigint) as bs from documents)
select doc_id, bytes::integer as bytes, xor(list_reduce(list_prepend(4294967295::bigint, bs), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::bigint) as crc from b, tab"""


@query(CRC_SQL)
def text_crc32(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.crc32(F.col("text").cast("binary")).alias("crc"), F.octet_length("text").alias("bytes"))


DEMO_KEY = b"demonstration key"
_PADS = [bytes(k ^ p for k in DEMO_KEY.ljust(64, b"\0")).hex() for p in (0x36, 0x5C)]


@query(f"""with p as (select page_id, 'run' || chr(92) || 'p (' || page_id || ')~.md' as rel, 'run/p (' || page_id || ')~.md' as path, 1700000000 + page_id as expires from pages),
m as (select *, to_base64(unhex(sha256(unhex('{_PADS[1]}') || unhex(sha256(unhex('{_PADS[0]}') || encode(page_id % 3 || '|' || path || '.' || expires)))))) as mac from p),
t as (select *, rtrim(replace(replace(mac, '+', '-'), '/', '_'), '=') || '.' || expires as token from m)
select page_id, rel, token, '/artifact?w=' || page_id % 3 || '&p=run%2Fp%20(' || page_id || ')~.md&t=' || token as url,
  case when page_id % 5 = 4 then 'bad' when expires < 1700000010 then 'expired' else 'ok' end as verdict from t""")
def capability_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signed links with a demonstration key, and what checking them says before and after they end, or of a later end that was not signed."""
    sign, check = artifacts.capability_token(DEMO_KEY), artifacts.capability_check(DEMO_KEY)
    n = F.col("page_id").cast("string")
    d = table(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("run\\p ("), n, F.lit(")~.md")).alias("rel"), (F.lit(1_700_000_000) + F.col("page_id")).alias("expires"), (F.col("page_id") % 3).alias("w"))
    d = d.withColumn("signed", artifacts.signed_path(F.col("w"), F.col("rel"))).withColumn("token", sign("signed", "expires"))
    shown = F.when(F.col("page_id") % 5 == 4, F.concat("token", F.lit("9"))).otherwise(F.col("token"))
    return d.select("page_id", "rel", "token", artifacts.capability_url(F.lit("/artifact"), F.col("w"), F.col("rel"), F.col("token")).alias("url"), check("signed", shown, F.lit(1_700_000_010)).alias("verdict"))


def demo_rows() -> list[tuple[str, bytes]]:
    """A handful of archives made here: good, nested, unsafe and damaged ones."""

    def made(files: dict[str, bytes], method: int = zipfile.ZIP_DEFLATED) -> bytes:
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", method) as z:
            for name, data in files.items():
                z.writestr(zipfile.ZipInfo(name, (2024, 1, 1, 0, 0, 0)), data, method)
        return out.getvalue()

    files = {"full.md": b"# Title\n" * 50, "images/a.png": b"\x89PNG", "layout.json": b"{}"}
    good, plain = made(files), made(files, zipfile.ZIP_STORED)
    flipped = plain.replace(b"\x89PNG", b"\x88PNG")  # stored as it is, so that the byte is there to flip
    assert flipped != plain
    return [("good", good), ("stored", made({"x/full.md": b"text"}, zipfile.ZIP_STORED)), ("bzip", made({"a": b"b" * 99}, zipfile.ZIP_BZIP2)), ("evil", made({"../evil": b"x"})), ("cut", good[:-30]), ("none", b""), ("flipped", flipped)]


def demo_archives(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(n, bytearray(d)) for n, d in demo_rows()], "archive string, content binary")


def archive_rows() -> tuple[str, str]:
    """The rows of ``zip_scan`` and ``zip_extract`` as SQL, by Python's own reader of archives; the damaged ones' errors are written down."""
    text = lambda v: "null" if v is None else "'" + v.replace("'", "''") + "'"
    scans, files = [], []
    for name, data in demo_rows():
        if name in ("cut", "none"):
            scans.append(f"({text(name)}, {', '.join(['null'] * 10)}, 'CORRUPT')")
            files.append(f"({text(name)}, null, null, null, null, 'CORRUPT', null)")
            continue
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            for i, e in enumerate(z.infolist()):
                scans.append(f"({text(name)}, {i}, {text(e.filename)}, {e.compress_type}, {e.flag_bits}, {e.compress_size}, {e.file_size}, {e.header_offset}, {e.CRC}, {e.external_attr}, {str(e.is_dir()).lower()}, null)")
                if name in ("good", "stored"):
                    files.append(f"({text(name)}, {i}, {text(e.filename)}, {e.file_size}, '{z.read(e).hex().upper()}', null, {e.CRC})")
            if name not in ("good", "stored"):
                files.append(f"({text(name)}, null, null, null, null, '{ {'bzip': 'UNSUPPORTED', 'evil': 'UNSAFE', 'flipped': 'CORRUPT'}[name] }', null)")
    kinds = "ordinal::int as ordinal, name, method::int as method, flags::int as flags, compressed_size::bigint as compressed_size, uncompressed_size::bigint as uncompressed_size, local_offset::bigint as local_offset, crc32::bigint as crc32, external_attr::bigint as external_attr, is_dir::boolean as is_dir, error"
    return (
        f"select archive, {kinds} from (values {', '.join(scans)}) t(archive, ordinal, name, method, flags, compressed_size, uncompressed_size, local_offset, crc32, external_attr, is_dir, error)",
        f"select archive, ordinal::int as ordinal, name, size::bigint as size, content, error, crc::bigint as crc from (values {', '.join(files)}) t(archive, ordinal, name, size, content, error, crc)",
    )


@rule()
def zip_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive.scan(demo_archives(spark))


@rule()
def zip_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = archive.extracted(demo_archives(spark))
    return d.withColumn("crc", F.crc32("content")).withColumn("content", F.hex("content"))


@rule("select error_code as code, message from (values " + ERROR_VALUES + ") t(error_code, message)")
def error_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return error_table(spark)


RULE_SQL["zip_scan"], RULE_SQL["zip_extract"] = archive_rows()
