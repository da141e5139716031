"""Serving against a folder on disk, notices against Python, progress against counts."""

import os
import random

from pyspark.sql import functions as F

from millrace.functions import names
from millrace.operators import serving
from millrace.streaming import progress


def on_disk(root, rel, most):
    """The answer of a program that looks at the disk."""
    rel = (rel or "").replace("\\", "/")
    path = os.path.normpath(os.path.join(root, rel))
    if not rel or ".." in rel or rel.startswith("/") or not path.startswith(root + os.sep):
        return None, "ARTIFACT_BAD_PATH"
    if not os.path.isfile(path):
        return None, "ARTIFACT_NOT_FOUND"
    size = os.path.getsize(path)
    return size, "ARTIFACT_TOO_LARGE" if size > most else None


def test_served_as_by_a_look_at_the_disk(spark, tmp_path):
    r, root, files = random.Random(3), str(tmp_path), {}
    for k in range(40):
        path = "/".join(f"d{r.randrange(4)}" for _ in range(r.randrange(3))) + f"/f{k}.md"
        files[path.lstrip("/")] = r.randrange(60)
    for path, size in files.items():
        os.makedirs(os.path.dirname(f"{root}/{path}"), exist_ok=True)
        with open(f"{root}/{path}", "wb") as f:
            f.write(b"x" * size)
    asked = [None, "", ".", "./", "..", "a..b", "/etc", "\\etc", "d0", "d1/", "no.md", "d0/d1/d2/d3"]
    asked += [r.choice(["{}", "./{}", "{}/", "x/../{}", "{}x"]).format(p).replace("/", r.choice(["/", "//", "\\", "/./"])) for p in files for _ in range(4)]
    requests = spark.createDataFrame([(i, a, 7, "old") for i, a in enumerate(asked)], "id int, rel string, size int, serve_error string")
    stated = spark.createDataFrame([*files.items(), *list(files.items())[:3], (None, 5)], "path string, size long")
    got = {x.id: (x.serve_bytes, x.serve_error) for x in serving.served(requests, stated, most_bytes=30).collect()}
    for i, a in enumerate(asked):
        if not (a or "").replace("\\", "/").endswith("/") or on_disk(root, a, 30)[1] != "ARTIFACT_NOT_FOUND":
            assert got[i] == on_disk(root, a, 30), a
    assert len(got) == len(asked)
    assert serving.served(requests.limit(0), stated).count() == 0
    none = serving.served(requests, stated.limit(0)).collect()
    assert {x.serve_error for x in none} == {"ARTIFACT_BAD_PATH", "ARTIFACT_NOT_FOUND"} and {x.size for x in none} == {7}


def test_notice_where_a_preview_was_cut(spark):
    r = random.Random(4)
    texts = [None, "", "x" * 20, "x" * 21, "é" * 10, "é" * 11, "aéééééééééééé", "日本語" * 5] + ["".join(r.choice("aé日𝄞�") for _ in range(r.randrange(16))) for _ in range(200)]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    for x in d.select("id", names.preview_with_notice(F.col("text"), 20).alias("p")).collect():
        raw = (texts[x.id] or "").encode()
        assert x.p == (raw.decode() if len(raw) <= 20 else raw[:20].decode("utf-8", "ignore") + names.NOTICE), texts[x.id]


def test_progress_of_every_micro_batch(spark, tmp_path):
    sizes = [5, 2, 9]
    for k, n in enumerate(sizes):
        spark.range(n).coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in")
        for name in os.listdir(f"{tmp_path}/in"):  # files are read in order of their time
            if name.endswith(".parquet") and os.path.getmtime(f"{tmp_path}/in/{name}") > 1e6:
                os.utime(f"{tmp_path}/in/{name}", (1000 * (k + 1), 1000 * (k + 1)))
    stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(f"file://{tmp_path}/in")
    args = {"rows": F.count(F.lit(1)), "least": F.min("id"), "big": F.count_if(F.col("id") > 3)}, f"file://{tmp_path}/table", f"file://{tmp_path}/c", f"file://{tmp_path}/out"
    assert progress.progress(spark, f"file://{tmp_path}/table").count() == 0
    got = progress.drain_observed(stream, *args).orderBy("batch_id").collect()
    assert [(x.batch_id, x.n_input, x.metrics) for x in got] == [(k, n, {"rows": n, "least": 0, "big": max(0, n - 4)}) for k, n in enumerate(sizes)]
    spark.range(3).coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in")
    again = progress.drain_observed(stream, *args).orderBy("batch_id").collect()  # goes on where it was
    assert [x.metrics["rows"] for x in again] == [*sizes, 3] and len({x.query for x in again}) == 1 and len({x.run for x in again}) == 2
    assert spark.read.parquet(f"file://{tmp_path}/out").count() == sum(sizes) + 3
