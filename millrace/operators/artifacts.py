"""Landed files: description, signed links, run metadata."""

from __future__ import annotations

import base64
import hashlib
import hmac
import re
import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import names
from millrace.functions.dimensions import with_mime


def describe(df: DataFrame, name: str = "name") -> DataFrame:
    """Adds ext, kind, mime, inline."""
    d = df.withColumn("ext", names.suffix(F.col(name)))
    return with_mime(d, F.col("ext")).withColumn("kind", names.kind(F.col(name))).withColumn("inline", names.inlineable(F.col(name)))


def listing(files: DataFrame) -> DataFrame:
    """name, path, bytes of a ``binaryFile`` frame; the contents are never read."""
    return files.select(F.regexp_extract("path", r"([^/]*)$", 1).alias("name"), "path", F.col("length").alias("bytes"))


def sign(key: bytes, rel: str, expires: int) -> str:
    """Token of a relative path until ``expires``; either slash names the same path."""
    rel = rel.replace("\\", "/")
    mac = hmac.new(key, f"{rel}.{expires}".encode(), hashlib.sha256).digest()
    return base64.urlsafe_b64encode(mac).decode().rstrip("=") + f".{expires}"


def capability_token(key: bytes):
    """A Pandas UDF (rel, expires) -> token. The key stays in the closure, out of plans and logs."""

    @F.pandas_udf("string")
    def token(rel: pd.Series, expires: pd.Series) -> pd.Series:
        return pd.Series([None if pd.isna(r) or pd.isna(e) else sign(key, r, int(e)) for r, e in zip(rel, expires, strict=True)], dtype=object)

    return token


def capability_check(key: bytes):
    """A Pandas UDF (rel, token, now) -> ok | expired | bad. What is missing or malformed is bad."""

    @F.pandas_udf("string")
    def check(rel: pd.Series, token: pd.Series, now: pd.Series) -> pd.Series:
        out = []
        for r, t, n in zip(rel, token, now, strict=True):
            end = None if pd.isna(r) or pd.isna(t) or pd.isna(n) else re.fullmatch(r"[^.]*\.([0-9]{1,18})", t)
            good = end is not None and hmac.compare_digest(sign(key, r, int(end[1])).encode(), t.encode())
            out.append("bad" if not good else "expired" if int(end[1]) < n else "ok")
        return pd.Series(out, dtype=object)

    return check


def signed_path(workspace: Column, rel: Column) -> Column:
    """What the token of an artifact signs: the index of its workspace, and its path with forward slashes."""
    return F.concat_ws("|", workspace.cast("string"), F.replace(rel, F.lit("\\"), F.lit("/")))


def capability_url(base: Column, workspace: Column, rel: Column, token: Column) -> Column:
    path = F.replace(rel, F.lit("\\"), F.lit("/"))
    return F.concat(base, F.lit("?w="), workspace.cast("string"), F.lit("&p="), names.coded(path), F.lit("&t="), names.coded(token))


def write_run(df: DataFrame, path: str) -> None:
    """Run metadata as JSON lines; the job's commit makes it all or nothing."""
    df.write.mode("errorifexists").json(path)


def write_texts(df: DataFrame, path: str) -> None:
    """Texts as UTF-8 files of their ``name`` in one folder: written aside first, then named, so that a task that runs twice leaves whole files."""

    def put(batches):
        for batch in batches:
            for name, text in zip(batch["name"], batch["text"], strict=True):
                write_file(path, name, (text or "").encode())
            yield pd.DataFrame({"n": [len(batch)]})

    df.select("name", "text").mapInPandas(put, "n long").agg(F.sum("n")).collect()


def write_file(folder: str, name: str, data: bytes) -> None:
    import pyarrow.fs

    fs, root = pyarrow.fs.FileSystem.from_uri(folder)
    fs.create_dir(root, recursive=True)
    aside = f"{root}/_{uuid.uuid4().hex}"
    with fs.open_output_stream(aside) as out:
        out.write(data)
    fs.move(aside, f"{root}/{name}")
