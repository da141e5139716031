"""Small dimension tables of the ingestion contracts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Extensions that the service accepts.
SUPPORTED = (".pdf", ".doc", ".docx", ".ppt", ".pptx", ".xls", ".xlsx", ".png", ".jpg", ".jpeg", ".jp2", ".webp", ".gif", ".bmp", ".html", ".htm")
# Accepted ones that the light tier rejects.
LIGHT_UNSUPPORTED = (".html", ".htm", ".doc", ".ppt", ".xls")
# Size limits of the tiers, batch limits.
SIZE_LIMITS = {"precision": 200 * 1024 * 1024, "agent": 10 * 1024 * 1024}
BATCH_LIMITS = {"url": 200, "file": 50}
CALL_LIMIT = 1000

# Media types by extension.
MIME = {
    ".md": "text/markdown; charset=utf-8",
    ".json": "application/json; charset=utf-8",
    ".txt": "text/plain; charset=utf-8",
    ".png": "image/png",
    ".jpg": "image/jpeg",
    ".jpeg": "image/jpeg",
    ".jp2": "image/jp2",
    ".webp": "image/webp",
    ".gif": "image/gif",
    ".bmp": "image/bmp",
    ".pdf": "application/pdf",
    ".docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    ".pptx": "application/vnd.openxmlformats-officedocument.presentationml.presentation",
    ".xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    ".doc": "application/msword",
    ".ppt": "application/vnd.ms-powerpoint",
    ".xls": "application/vnd.ms-excel",
    ".zip": "application/zip",
    ".html": "text/html; charset=utf-8",
    ".htm": "text/html; charset=utf-8",
    ".svg": "image/svg+xml",
}
OTHER_MIME = "application/octet-stream"
# Extensions that may be shown inline.
INLINE = (".md", ".json", ".txt", ".png", ".jpg", ".jpeg", ".jp2", ".webp", ".gif", ".bmp")

# Error codes of the service; the messages are ours.
ERRORS = {
    "A0202": "The token is wrong.",
    "A0211": "The token has expired.",
    "-500": "The parameters are wrong.",
    "-10001": "The service failed.",
    "-10002": "The request's parameters are wrong.",
    "-60001": "No upload link could be made.",
    "-60002": "The file type is not recognised.",
    "-60003": "The file could not be read.",
    "-60004": "The file is empty.",
    "-60005": "The file is too large.",
    "-60006": "The file has too many pages.",
    "-60007": "The model service is unavailable.",
    "-60008": "Reading the file timed out.",
    "-60009": "The submission queue is full.",
    "-60010": "Parsing failed.",
    "-60011": "No valid file was uploaded.",
    "-60012": "The task was not found.",
    "-60013": "The task belongs to someone else.",
    "-60014": "A running task can't be deleted.",
    "-60015": "The file could not be converted.",
    "-60016": "The export format could not be made.",
    "-60017": "The retries are used up.",
    "-60018": "The daily task limit is reached.",
    "-60019": "The daily limit for HTML is reached.",
    "-60020": "The file could not be split.",
    "-60021": "The page count could not be read.",
    "-60022": "The web page could not be read.",
    "-30001": "The file is too large for the light tier.",
    "-30002": "The light tier does not take this file type.",
    "-30003": "The file has too many pages for the light tier.",
    "-30004": "The light tier's parameters are wrong.",
}


def error_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(sorted(ERRORS.items()), "code string, message string")


def mime_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(sorted(MIME.items()), "ext string, mime string")


def with_error_message(df: DataFrame, code: Column, name: str) -> DataFrame:
    """Left lookup of one code. The dimension has 31 fixed rows, so broadcasting it is safe at any scale."""
    dim = F.broadcast(error_table(df.sparkSession)).select(F.col("code").alias("_code"), F.col("message").alias(name))
    return df.join(dim, code.cast("string") == F.col("_code"), "left").drop("_code")


def with_mime(df: DataFrame, ext: Column) -> DataFrame:
    """Left lookup in 21 fixed rows."""
    dim = F.broadcast(mime_table(df.sparkSession)).select(F.col("ext").alias("_ext"), F.col("mime").alias("_mime"))
    return df.join(dim, ext == F.col("_ext"), "left").withColumn("mime", F.coalesce("_mime", F.lit(OTHER_MIME))).drop("_ext", "_mime")
