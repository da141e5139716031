"""Queries of calls against their SQL, and the rules of the new operators that no table holds."""

import duckdb
import pytest
from pyspark.sql import functions as F

from millrace.functions import names
from millrace.operators import admission, archive, artifacts, limits
from millrace.plans import calls, catalogue, flows
from millrace.sources.service import Ledger, ServiceError, within

SMALL = "/root/testdata/sf0.001"
ALL, SQL = catalogue.QUERIES | catalogue.RULES, catalogue.ORACLE_SQL | catalogue.RULE_SQL
CALLS = [n for n, f in ALL.items() if f.__module__ in (calls.__name__, flows.__name__) or n in catalogue.RULES]


@pytest.mark.parametrize("name", [*CALLS, "capability_tokens", "text_crc32", "zip_scan", "zip_extract"])
def test_query_equals_its_sql(spark, name):
    got = ALL[name](spark, SMALL)
    db = duckdb.connect()
    for t in ("pages", "events", "documents"):
        db.execute(f"create view {t} as select * from read_parquet('{SMALL}/{t}.parquet')")
    want = db.sql(SQL[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    key = lambda r: tuple(str(bytes(v) if isinstance(v, bytearray) else v) for v in r)
    assert sorted(key(r) for r in got.select(*columns).collect()) == sorted(key(r) for r in want.select(*(f'"{c}"' for c in columns)).fetchall())


def test_calls_have_queries():
    assert len(CALLS) >= 15


def test_null_urls_are_not_valid(spark):
    rows = spark.createDataFrame([("a", None), ("b", "x.pdf"), ("c", "http://h")], "k string, u string").select("k", names.valid_url(F.col("u")).alias("ok")).collect()
    assert {r["k"]: r["ok"] for r in rows} == {"a": False, "b": False, "c": True}


def test_marks_in_urls_stay(spark):
    d = spark.createDataFrame([("a b!'()*~/\u00e9&",), (None,)], "s string")
    assert [r[0] for r in d.select(names.coded(F.col("s"))).collect()] == ["a%20b!'()*~%2F%C3%A9%26", None]


def test_headers_merge_over_nulls(spark):
    d = spark.sql("select map('a', '1') as x, cast(null as map<string,string>) as n")
    assert d.select(names.merged(F.col("x"), F.col("n")), names.merged(F.col("n"), F.col("x")), names.merged(F.col("n"), F.col("n"))).first()[:] == ({"a": "1"}, {"a": "1"}, {})


def test_polling_at_the_edges(spark):
    rows = [(0, 10, 100, "DONE", 1), (10, 10, 100, "DONE", 2), (11, 10, 100, "DONE", 3), (100, 10, 100, "DONE", 11), (101, 10, 100, "TIMEOUT", 11), (None, 10, 100, "TIMEOUT", 11), (-5, 10, 100, "DONE", 1)]
    d = spark.createDataFrame(rows, "d long, i long, t long, outcome string, n long")
    outcome, queries = limits.polled(F.col("d"), F.col("i"), F.col("t"))
    assert d.filter((outcome != F.col("outcome")) | (queries != F.col("n"))).count() == 0


def test_batch_bodies_of_an_empty_table(spark):
    columns = "call long, chunk_no long, in_chunk long, name string, own_id string, data_id string, is_ocr boolean, page_ranges string, model_version string, enable_formula boolean, enable_table boolean, language string, extra_formats array<string>"
    assert admission.batch_bodies(spark.createDataFrame([], columns), ["call"], "name").collect() == []
    one = [(1, 0, 1, 'a"b', None, "doc-1", None, "", "vlm", True, False, "ch", [])]
    body = admission.batch_bodies(spark.createDataFrame(one, columns), ["call"], "name").first()["body"]
    assert body == '{"files":[{"name":"a\\"b","data_id":"doc-1"}],"model_version":"vlm","enable_formula":true,"enable_table":false,"language":"ch"}'


def test_texts_written_twice_are_whole(spark, tmp_path):
    d = spark.createDataFrame([("a.md", "x" * 100_000), ("b.md", None)], "name string, text string")
    for _ in range(2):
        artifacts.write_texts(d, f"file://{tmp_path}/run")
    assert {p.name: p.stat().st_size for p in (tmp_path / "run").iterdir()} == {"a.md": 100_000, "b.md": 0}


def test_main_text_of_nothing(spark):
    d = spark.createDataFrame([], "archive string, content binary")
    assert archive.main_texts(d, 10).collect() == []


def test_ledger_survives_a_cut_line(tmp_path):
    a = Ledger(str(tmp_path / "l"))
    a["x"], a["y"] = "1", "2"
    with open(a.path, "a") as f:
        f.write('{"z": "3')
    b = Ledger(a.path)
    assert dict(b) == {"x": "1", "y": "2"}
    b["z"] = "4"
    assert dict(Ledger(a.path)) == {"x": "1", "y": "2", "z": "4"}


def test_request_errors_reach_the_caller():
    def fails():
        raise ServiceError("429")

    with pytest.raises(ServiceError, match="429"):
        within(5, fails)
    assert within(5, lambda: 3) == 3
