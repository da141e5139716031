"""Ingestion engine: rules from the survey as tables of cases."""

import io
import struct
import zipfile

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.config import Config, ConfigError, layered
from millrace.functions import names
from millrace.operators import admission, archive, artifacts, limits, status
from millrace.sources.service import RateLimiter, ServiceError, Simulator, Submitter
from millrace.streaming import tasks


def column(spark, items, f):
    rows = spark.createDataFrame(list(enumerate(items)), "i int, s string").select("i", f(F.col("s")).alias("r")).collect()
    return [r["r"] for r in sorted(rows)]


def test_names(spark):
    urls = ["http://h/a/b.PDF?x=1#f", "HTTPS://h/a%20b.pdf/", "http://h", "http://h?q=/z.pdf", "http://h/.pdf", "x/y"]
    assert column(spark, urls, names.display_name) == ["b.PDF", "a%20b.pdf", "document", "document", ".pdf", "document"]
    files = ["Paper.PDF", ".pdf", "a.", "a.b.docx", "文档.pdf", "foopng", ""]
    assert column(spark, files, names.extension) == [".pdf", "", ".", ".docx", ".pdf", "", ""]
    assert column(spark, files, names.suffix) == [".pdf", ".pdf", ".", ".docx", ".pdf", "", ""]
    assert column(spark, ["foopng", "a.MD", "b.doc", "c.htm", "d.latex", "e"], names.kind) == ["image", "markdown", "docx", "html", "latex", "other"]
    assert column(spark, ["a b/c", "", "文", None], names.data_id) == ["a_b_c", None, "_", None]
    assert column(spark, ["--a b--", "文", "x" * 200], names.run_name) == ["a-b", "parse", "x" * 80]
    assert column(spark, ["..", "a", "文"], names.file_name) == [None, "a", None]
    assert column(spark, ["a\\b", "../x", "C:/x", "/x", "a/./b//c", "", "x..y"], names.entry_name) == ["a/b", None, None, None, "a/b/c", None, "x..y"]
    assert column(spark, ["0", "1023", "1024", "1289748", "5368709120", None], lambda c: names.format_bytes(c.cast("double"))) == ["0 B", "1023 B", "1.0 KB", "1.2 MB", "5.0 GB", "0 B"]


def test_preview_keeps_whole_characters(spark):
    texts = ["aé", "éé", "日本", "abc", "�x", "", None]
    for n in range(1, 7):
        want = [None if t is None else t.encode()[:n].decode("utf-8", "ignore") for t in texts]
        assert column(spark, texts, lambda c, n=n: names.preview(c, n)) == want


def test_admission(spark):
    rows = [("precision", ".pdf", 5), ("precision", ".exe", 5), ("agent", ".doc", 5), ("agent", ".pdf", 99), ("agent", ".pdf", 0), ("agent", ".pdf", None)]
    d = spark.createDataFrame(rows, "api string, ext string, size long")
    got = d.select(admission.reason(F.col("api"), F.col("ext"), F.col("size"), admission.size_limit(F.col("api"), F.lit(0), {"precision": 50, "agent": 10})).alias("r")).collect()
    assert [r["r"] for r in got] == [None, "UNSUPPORTED_TYPE", "AGENT_UNSUPPORTED", "TOO_LARGE", "EMPTY_FILE", "FILE_NOT_FOUND"]


@pytest.mark.parametrize(("per_minute", "burst"), [(40, 8), (900, 180), (1, 1)])
def test_throttle_is_the_token_bucket(spark, per_minute, burst):
    period = 60_000_000 // per_minute
    times = sorted((i * 7919 * 100_003) % 30_000_000 for i in range(300))
    clock, tokens, last, want = 0, burst * period, 0, []
    for t in times:  # one server, first come first served
        clock = max(clock, t)
        tokens = min(burst * period, tokens + clock - last)
        wait = max(0, period - tokens)
        clock, tokens = clock + wait, tokens + wait - period
        last = clock
        want.append(clock)
    d = spark.createDataFrame([(1, i, t) for i, t in enumerate(times)], "k int, i int, t long")
    got = limits.throttle(d, ["k"], "t", "i", period, burst).orderBy("i").collect()
    assert [r["release_us"] for r in got] == want
    assert limits.capacity(40) == 8


def test_status(spark):
    d = spark.createDataFrame([(1, 1, 1, "running"), (1, 2, 2, "done"), (2, 1, 3, "failed")], "t int, ts int, e int, state string")
    got = {r["t"]: (r["state"], r["is_terminal"]) for r in status.latest(d, "t", "ts", "e", "state").collect()}
    assert got == {1: ("done", True), 2: ("failed", True)}
    b = spark.createDataFrame([(1, "done", "u"), (1, "done", None), (2, None, None)], "b int, state string, zip_url string")
    got = {r["b"]: (r["done"], r["failed"], r["is_complete"]) for r in status.batch_progress(b, "b").collect()}
    assert got == {1: (1, 1, True), 2: (0, 1, False)}


def packed(files, method=zipfile.ZIP_DEFLATED):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", method) as z:
        for name, data in files:
            z.writestr(name, data)
    return out.getvalue()


def test_archives():
    good = packed([("full.md", b"x" * 1000), ("images/", b""), ("images/a.png", b"p")])
    assert dict(archive.extract(good)) == {"full.md": b"x" * 1000, "images/a.png": b"p"}
    assert archive.main_document(["a/full.md", "full.md"]) == "full.md"
    assert archive.entry_text(good, "full.md", 10) == (b"x" * 10, True, 1000)
    assert archive.entry_text(good, "none", 10) is None
    bad = good.replace(b"PK\x01\x02", b"PK\x01\x03", 1)
    encrypted = bytearray(packed([("a", b"b")]))
    at = encrypted.find(b"PK\x01\x02")
    encrypted[at + 8] |= 1
    cases = [(packed([("../evil", b"")]), "UNSAFE"), (packed([("/abs", b"")]), "UNSAFE"), (packed([("a", b"b" * 50)], zipfile.ZIP_BZIP2), "UNSUPPORTED"), (bad, "CORRUPT"), (bytes(encrypted), "UNSUPPORTED"), (good[:-30], "CORRUPT"), (b"", "CORRUPT")]
    crc = bytearray(packed([("a", b"b")]))
    struct.pack_into("<I", crc, crc.find(b"PK\x01\x02") + 16, 7)
    for data, code in [*cases, (bytes(crc), "CORRUPT")]:
        with pytest.raises(archive.ArchiveError) as x:
            list(archive.extract(data))
        assert x.value.code == code
    with pytest.raises(archive.ArchiveError):
        list(archive.extract(good, max_entries=2))
    with pytest.raises(archive.ArchiveError):
        list(archive.extract(good, max_total=1000))


@given(st.text())
def test_safe_names_stay_inside(name):
    try:
        safe = archive.safe_name(name)
    except archive.ArchiveError:
        return
    assert safe and not safe.startswith("/") and ".." not in safe.split("/") and archive.safe_name(safe) == safe


def test_config():
    assert Config().check() and layered({"mode": "agent"}, {"mode": "precision"}).mode == "precision"
    for bad in ({"mode": "x"}, {"poll_rate_per_min": 9}, {"artifact_root_name": "a/b"}, {"api_base_url": "ftp://x"}, {"nope": 1}):
        with pytest.raises(ConfigError):
            layered(bad)


def test_service():
    t = [0.0]
    sleep = lambda s: t.__setitem__(0, t[0] + s)
    sim = Simulator()
    s = Submitter(sim, RateLimiter(60, 2, now=lambda: t[0], sleep=sleep), 3, sleep=sleep)
    ids = s.submit([("a", {}), ("b", {"fail": True}), ("a", {})], "d")
    assert list(ids) == ["a", "b"] and len(sim.tasks) == 2
    assert s.wait(ids["a"], 1, 10, now=lambda: t[0])["state"] == "done"
    with pytest.raises(ServiceError):
        s.wait(ids["b"], 1, 10, now=lambda: t[0])
    with pytest.raises(ServiceError):
        s.submit([("c", {}), ("d", {})], "d")


def test_tokens(spark):
    d = spark.createDataFrame([("a", 10), ("b", 5)], "rel string, e long").withColumn("t", artifacts.capability_token(b"k")("rel", "e"))
    check = artifacts.capability_check(b"k")
    assert [r[0] for r in d.select(check("rel", "t", F.lit(7))).collect()] == ["ok", "expired"]
    assert [r[0] for r in d.select(check(F.lit("z"), "t", F.lit(7))).collect()] == ["bad", "bad"]


def test_stream(spark, tmp_path):
    spark.createDataFrame([("a", "2024-01-01 00:00:00", 1, "running"), ("a", "2024-01-01 00:01:00", 2, "done")], "task_id string, ts string, seq int, state string").select("task_id", F.to_timestamp("ts").alias("ts"), "seq", "state").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("task_id string, ts timestamp, seq int, state string").parquet(str(tmp_path / "in"))
    q = tasks.latest_states(stream).writeStream.outputMode("complete").format("memory").queryName("latest").start()
    q.processAllAvailable()
    q.stop()
    assert [(r["task_id"], r["state"], r["n_records"]) for r in spark.table("latest").collect()] == [("a", "done", 2)]


def test_tokens_fail_closed(spark):
    sign, check = artifacts.capability_token(b"k"), artifacts.capability_check(b"k")
    d = spark.createDataFrame([("a", None), ("a", 10), (None, 10), ("b\\c", 10)], "rel string, e long").withColumn("t", sign("rel", "e"))
    rows = d.collect()
    assert [r["t"] is None for r in rows] == [True, False, True, False]
    good = rows[1]["t"]
    cases = [("a", good, 5, "ok"), ("a", good, 11, "expired"), ("a", good, None, "bad"), ("a", None, 5, "bad"), (None, good, 5, "bad"), ("a", "é.5", 5, "bad"), ("a", "x.²", 5, "bad"), ("a", "", 5, "bad"), ("a", good + "0", 5, "bad"), ("b/c", rows[3]["t"], 5, "ok")]
    frame = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, rel string, t string, n long, want string")
    got = frame.select("i", "want", check("rel", "t", "n").alias("got")).orderBy("i").collect()
    assert [r["got"] for r in got] == [c[3] for c in cases]


def test_paths_with_backslashes(spark):
    assert column(spark, ["\\etc\\x", "a\\..\\b", "a\\b", "a/b", "", None], names.servable) == [False, False, True, True, False, False]


def test_archives_cut_records_and_written_names():
    good = packed([("./full.md", b"text"), ("a.txt", b"b")])
    assert archive.entry_text(good, "full.md", 100) == (b"text", False, 4)
    with pytest.raises(archive.ArchiveError):
        archive.entry_text(packed([("../full.md", b"text")]), "full.md", 100)
    cut = bytearray(good)
    at = cut.rfind(b"PK\x01\x02")
    struct.pack_into("<H", cut, at + 28, 60000)  # a name beyond the directory
    with pytest.raises(archive.ArchiveError) as x:
        archive.directory(bytes(cut))
    assert x.value.code == "CORRUPT"


def test_batches_uploads_and_waits():
    t, slept = [0.0], []
    sleep = lambda s: (slept.append(s), t.__setitem__(0, t[0] + s))
    sim = Simulator()
    s = Submitter(sim, RateLimiter(60, 2, now=lambda: t[0], sleep=sleep), 300, sleep=sleep)
    batch = s.submit_urls("u", [{"url": "x"}] * 200, "d")
    assert s.submit_urls("u", [{"url": "x"}] * 200, "d") == batch and s.used["d"] == 200 and len(sim.tasks) == 1
    for f, items in ((s.submit_urls, [{}] * 201), (s.submit_files, [("a", b"")] * 51)):
        with pytest.raises(ServiceError) as x:
            f("big", items, "d")
        assert x.value.code == "BATCH_TOO_LARGE"
    states = []
    got = s.submit_files("f", [("a.pdf", b"A"), ("b.pdf", b"B")], "d", states.append)
    assert [sim.results[f"{got}/{i}"] for i in range(2)] == [b"A", b"B"] and states == ["submitted", "uploading a.pdf", "uploading b.pdf", "uploaded"]
    sim.put = lambda link, data: 403
    with pytest.raises(ServiceError) as x:
        s.submit_files("g", [("a.pdf", b"A")], "d")
    assert x.value.code == "UPLOAD_FAILED" and "g" not in s.ledger
    answers = iter([ServiceError("429", retry_after="7"), ServiceError("429", retry_after="soon"), "id"])

    def busy(body):
        a = next(answers)
        if isinstance(a, ServiceError):
            raise a
        return a

    sim.submit, slept[:] = busy, []
    assert s.submit([("r", {})], "d")["r"] == "id" and slept[-2:] == [7, 30]
    assert ServiceError("429", retry_after="500").wait_s() == 120
    with pytest.raises(ServiceError) as x:
        s.wait(batch, 1, -1, now=lambda: t[0])
    assert x.value.code == "TIMEOUT"


def test_limiter_is_reconfigured_and_keeps_its_tokens():
    t = [0.0]
    limiter = RateLimiter(60, 4, now=lambda: t[0], sleep=lambda s: t.__setitem__(0, t[0] + s))
    for _ in range(3):
        limiter.take()
    limiter.reconfigure(30, 8)  # one token left
    limiter.take()
    assert t[0] == 0
    limiter.take()
    assert abs(t[0] - 2) < 1e-9
    limiter.reconfigure(60, 1)
    limiter.take()
    assert abs(t[0] - 3) < 1e-9


def test_daily_quota_runs_over_slots(spark):
    rows = [(i, f"2024-01-0{1 + i // 50}", (i * 37 % 50) // 7, 1 + i % 3) for i in range(100)]
    d = spark.createDataFrame(rows, "i int, day string, slot int, cost int")
    got = {r["i"]: r["used"] for r in limits.daily_quota(d, "day", "slot", ["i"], "cost", 20).collect()}
    for day in ("2024-01-01", "2024-01-02"):
        total = 0
        for i, _, _, cost in sorted((r for r in rows if r[1] == day), key=lambda r: (r[2], r[0])):
            total += cost
            assert got[i] == total


def test_refused_calls_and_pairs(spark):
    d = spark.createDataFrame([(1, i) for i in range(5)] + [(2, 0)], "call int, i int")
    assert [tuple(r) for r in admission.refused_calls(d, "call", 4).collect()] == [(1, 5, "BATCH_TOO_LARGE")]
    p = spark.createDataFrame([(1, ["a", "b"], ["x", "y"])], "call int, items array<string>, links array<string>")
    assert sorted(tuple(r) for r in admission.paired(p).collect()) == [(1, "a", "x"), (1, "b", "y")]
