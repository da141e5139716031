"""Registered queries of what a user is shown: previews with their notice, artifacts that may be served, progress of a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import names
from millrace.operators import serving
from millrace.plans.catalogue import DEMO_LIMITS, PREVIEW, STATE_SQL, query, table
from millrace.plans.flows import record_stream
from millrace.storage import shared_path
from millrace.streaming.progress import drain_observed

NOTICE_SQL = "chr(10) || '" + names.NOTICE.removeprefix("\n") + "'"


@query(f"""select doc_id, case when strlen(t) <= {PREVIEW} then t else head[1:list_max(list_filter(range(0, {PREVIEW + 1}), lambda k: strlen(head[1:k]) <= {PREVIEW}))] || {NOTICE_SQL} end as markdown,
  strlen(t) > {PREVIEW} as truncated, strlen(t)::bigint as bytes from (select doc_id, coalesce(text, '') as t, coalesce(text, '')[1:{PREVIEW}] as head from documents)""")
def preview_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a reader is shown of each document, with a notice where it was cut."""
    t = F.coalesce("text", F.lit(""))
    return table(spark, sf_dir, "documents").select("doc_id", names.preview_with_notice(t, PREVIEW).alias("markdown"), names.truncated(t, PREVIEW).alias("truncated"), F.octet_length(t).cast("long").alias("bytes"))


#: Pages a run, and the ways in which a request may name an artifact.
RUN_PAGES = 100
WAYS_SQL = "case page_id % 8 when 0 then run || '/' || p when 1 then run || '//./' || p when 2 then run when 3 then run || '/../' || p when 4 then '/' || run || '/' || p when 5 then './' when 6 then run || '\\' || p else run || '/' || p || '.bak' end"


@query(f"""with d as (select page_id, 'run-' || page_id // {RUN_PAGES} as run, 'p-' || page_id || '.html' as p, strlen(html)::bigint as size from pages), r as (select *, {WAYS_SQL} as rel from d)
select page_id, rel, case when page_id % 8 in (0, 1, 6) then size else 0 end as bytes, case when page_id % 8 in (3, 4, 5) then 'ARTIFACT_BAD_PATH' when page_id % 8 in (2, 7) then 'ARTIFACT_NOT_FOUND' when size > {DEMO_LIMITS["precision"]} then 'ARTIFACT_TOO_LARGE' end as error from r""")
def served_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the artifact that each request names may be served: pages are the artifacts of runs."""
    n = F.col("page_id")
    d = table(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("run-"), F.floor(n / RUN_PAGES).cast("string")).alias("run"), F.concat(F.lit("p-"), n.cast("string"), F.lit(".html")).alias("p"), F.octet_length("html").cast("long").alias("size"))
    run, p = F.col("run"), F.col("p")
    ways = [(run, "/", p), (run, "//./", p), (run,), (run, "/../", p), ("/", run, "/", p), ("./",), (run, "\\", p), (run, "/", p, ".bak")]
    rel = F.lit(None).cast("string")
    for k, parts in enumerate(ways):
        rel = F.when(n % 8 == k, F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])).otherwise(rel)
    files = d.select(F.concat(run, F.lit("/"), p).alias("path"), "size")
    got = serving.served(d.select("page_id", rel.alias("rel")), files, "rel", DEMO_LIMITS["precision"])
    return got.select("page_id", "rel", F.coalesce("serve_bytes", F.lit(0)).alias("bytes"), F.col("serve_error").alias("error"))


@query(f"""with r as (select event_id % 3 as part, {STATE_SQL} as state from events)
select part, count(*) as n_input, count_if(state in ('done', 'failed'))::bigint as ended, count_if(state in ('pending', 'waiting-file'))::bigint as waiting, count_if(state = 'running')::bigint as running from r group by 1""")
def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How each of three streams came along: counts of its micro-batches, as a listener landed them in a table."""
    s, path = F.col("state"), shared_path(spark, "progress")
    metrics = {"ended": F.count_if(s.isin("done", "failed")), "waiting": F.count_if(s.isin("pending", "waiting-file")), "running": F.count_if(s == "running"), "passed": F.count(F.lit(1))}
    out = None
    for part in range(3):
        stream = record_stream(spark, sf_dir).filter(F.col("event_id") % 3 == part).select("event_id", "state")
        got = drain_observed(stream, metrics, f"{path}/table-{part}", f"{path}/checkpoint-{part}", f"{path}/rows-{part}").withColumn("part", F.lit(part).cast("long"))
        out = got if out is None else out.unionAll(got)
    m = {k: F.sum(F.col("metrics")[k]).alias("n_input" if k == "passed" else k) for k in metrics}
    return out.groupBy("part").agg(*m.values())
