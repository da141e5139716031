"""Helpers shared by the text operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Word and white-space classes of the contracts (ASCII white space only).
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"

#: Text bytes handled at once in a Python worker; arrays stay a small multiple of it.
CHUNK_BYTES = 1 << 20
#: Spark's setting that removes a plan's shuffle files when its execution ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where that is unset, a temporary one, on a local master only."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="millrace-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors.

    A write computes the plan once, where ``checkpoint()`` would compute it
    twice. Shuffle files of the plan go when the write ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.folder = path
    return out


def discard(*tables: DataFrame | None) -> None:
    """Delete materialized tables that no plan still to run reads. Those a returned result reads stay."""
    for t in tables:
        if t is not None:
            jvm = t.sparkSession.sparkContext._jvm
            path = jvm.org.apache.hadoop.fs.Path(t.folder)
            path.getFileSystem(t.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that none of ``df``'s columns has, whatever the case of letters."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def rows_of(df: DataFrame, id_col: str, text_col: str, *extra: Column) -> DataFrame:
    """Only the columns an operator reads, under fixed names, so clashing extra columns do no harm."""
    return df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), *extra)


def map_texts(
    df: DataFrame,
    schema: str,
    fn: Callable[[list[bytes], dict[str, pa.Array]], dict[str, object]],
    text: str = "text",
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """``mapInArrow`` that hands ``fn`` whole texts as UTF-8 bytes (null: empty), about ``chunk_bytes`` at once.

    ``fn(texts, columns)`` returns output columns by name. Batches are cut by
    bytes, not rows, so memory does not follow the row count of a batch.
    """
    from pyspark.sql.types import _parse_datatype_string
    from pyspark.sql.pandas.types import to_arrow_schema

    out_schema = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in cuts(batch, text, chunk_bytes):
                part = batch.slice(lo, hi - lo)
                texts = bytes_list(part.column(text))
                cols = {n: part.column(n) for n in part.schema.names if n != text}
                got = fn(texts, cols)
                yield pa.RecordBatch.from_arrays(
                    [x if isinstance(x, pa.Array) and x.type == f.type else pa.array(x, type=f.type) for f in out_schema for x in [got[f.name]]],
                    schema=out_schema,
                )

    return df.mapInArrow(run, schema)


def bytes_list(col: pa.Array) -> list[bytes]:
    return [x if x is not None else b"" for x in col.cast(pa.binary()).to_pylist()]


def cuts(batch: pa.RecordBatch, text: str, chunk_bytes: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``chunk_bytes`` of text, one row at least."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
    lo = total = 0
    for i, n in enumerate(sizes):
        if i > lo and total + n > chunk_bytes:
            yield lo, i
            lo, total = i, 0
        total += n
    if lo < len(sizes):
        yield lo, len(sizes)


def crc_mod(id_col: str, n: int) -> Column:
    """crc32 of the id as text modulo ``n``; a null id counts as the empty string."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % n
