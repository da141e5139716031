"""What the two exact repeat removers share: rows of anchored runs, and joins of results with texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import bytes_list, cuts

#: Bytes of text handled at once.
CHUNK = 1 << 20
#: Windows of a text handled at once; a longer text is cut into overlapping pieces.
PIECE = 1 << 22


def keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text (null: empty) and the row's key: did (nulls least), rid (hash of the text).

    Rows equal in both keys are equal rows and get equal results.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    did = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(-(1 << 63)))
    return df.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("text")).withColumn("did", did.alias("did")).withColumn("rid", F.xxhash64("text"))


#: Of the runs of some texts: the text of each, and its columns by name.
Runs = tuple[np.ndarray, dict[str, np.ndarray]]


def run_rows(docs: DataFrame, of: Callable[[list[bytes]], Runs], columns: str, keyed: bool = True) -> DataFrame:
    """``columns`` (a schema) of the anchored runs of all texts, with did and rid of the text if ``keyed``."""
    names = [c.split()[0] for c in columns.split(", ")]
    keys = ["did", "rid"] * keyed

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = [batch.column(k).to_numpy() for k in keys]
            for lo, hi in cuts(batch, "text", CHUNK):
                owner, of_run = of(bytes_list(batch.slice(lo, hi - lo).column("text")))
                yield pa.RecordBatch.from_arrays([*(pa.array(k[lo + owner]) for k in key), *(pa.array(of_run[c]) for c in names)], [*keys, *names])

    return docs.select(*keys, "text").mapInArrow(rows, ", ".join([*(f"{k} long" for k in keys), columns]))


def by_document(spans: DataFrame, *columns: str) -> DataFrame:
    """did, rid and the spans of each document, once each; a document's spans are bounded by its length."""
    return spans.groupBy("did", "rid").agg(F.collect_set(F.struct(*columns)).alias("spans"))


def with_texts(docs: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    return docs.join(lists, ["did", "rid"], how)


def struct_column(column: pa.Array, row: int, field: str) -> np.ndarray:
    return np.asarray(column[row].values.field(field)) if column[row].is_valid else np.zeros(0, np.int64)
