"""Columns with the operators' own helper names, and very long texts, through every operator."""

import hashlib
import random

import public_tokenizers
import pytest

import corpus_pipeline
from millrace.llm import bpe, common, langid, media, mixing, near_dedup, quality, secrets, substring_dedup, suffix_dedup, toxicity

CLASHES = ("k", "i", "_k", "_n", "tkey", "best", "place", "row_key", "n_take", "p_id", "p_key", "p_taken", "toxic_score", "gone", "__null", "size", "key", "at", "copies", "bucket", "a", "b", "held_out", "h")


@pytest.fixture(scope="module")
def clashing(spark):
    r = random.Random(1)
    texts = [" ".join(r.choice(["house", "river", "garden", "window", "letter"]) for _ in range(30)) for _ in range(12)]
    rows = [(i, t, "en", "ab"[i % 2], 0, *(["x"] * len(CLASHES))) for i, t in enumerate([*texts, texts[0], None, "", "token=abcdef99"])]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHES))


def test_clashing_columns_pass_through(spark, clashing, tmp_path):
    spark.createDataFrame([(0, 0), (1, 1), (2, 0)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, clashing, str(tmp_path))
        assert out.columns == clashing.columns, name
        assert all(r[c] == "x" for r in out.collect() for c in CLASHES), name
    assert near_dedup.deduplicate(clashing).count() == 14
    assert toxicity.score(clashing, toxicity.learn_from(clashing, spark.read.parquet(f"{tmp_path}/labels.parquet"))).columns.count("toxic_score") == 1


def test_operators_ignore_other_columns(spark, clashing):
    plain = clashing.select("doc_id", "text", "lang", "source")
    labels = spark.createDataFrame([(0, 1), (1, 0)], "doc_id long, quality int")
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    for f in (suffix_dedup.remove_repeats, substring_dedup.remove_earlier_windows, media.media_column, mixing.mix_sources, langid.identify, secrets.scan_secrets, lambda d: bpe.encode_documents(d, path, public_tokenizers.PATTERN), lambda d: quality.quality(d, labels)):
        assert sorted(map(str, f(clashing).collect())) == sorted(map(str, f(plain).collect()))


def test_very_long_texts(spark):
    """A text of 5 MB, beyond the pieces and chunks of every operator, and one word of 200 kB."""
    r = random.Random(2)
    words = [f"{r.choice('abcdef')}{r.randrange(10**6)}" for _ in range(700_000)]
    long, one = " ".join(words), "x" * 200_000
    passage = words[300_000:300_200]
    rows = [(1, long), (2, " ".join(["front", *passage, "back"])), (3, one)]
    df = spark.createDataFrame([(d, t, "en", "s") for d, t in rows], "doc_id long, text string, lang string, source string")
    shared = len(" ".join(passage).encode()) + 2
    got = {x["doc_id"]: x for x in suffix_dedup.remove_repeats(df).collect()}
    assert (got[1]["n_bytes"], got[1]["n_removed"], got[1]["n_spans"]) == (len(long), shared, 1) and got[2]["n_removed"] == shared and got[3]["n_removed"] == len(one)
    got = {x["doc_id"]: x for x in substring_dedup.remove_earlier_windows(df).collect()}
    assert [got[i]["n_removed"] for i in (1, 2, 3)] == [0, 200, 0] and got[1]["n_words"] == len(words)
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    assert {x["doc_id"]: x["decoded_sha256"] for x in bpe.encode_documents(df, path, public_tokenizers.PATTERN).collect()} == {d: digest(t) for d, t in rows}
    assert {x["doc_id"]: x["n_bytes"] for x in media.media_column(df).select("doc_id", "n_bytes").collect()} == {d: len(t) for d, t in rows}
    assert {x["doc_id"]: x["size"] for x in mixing.mix_sources(df).collect()} == {1: len(words), 2: 202, 3: 1}
    assert {x["doc_id"]: x["class_id"] for x in near_dedup.near_duplicates(df).collect()} == {1: 1, 2: 2, 3: 3}
    assert {x["doc_id"]: x["n_assign"] for x in secrets.scan_secrets(df).collect()} == {1: 0, 2: 0, 3: 0}
    assert langid.identify(df).count() == 3
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1)], "doc_id long, quality int, toxic int")
    assert {x["doc_id"]: x["n_words"] for x in quality.quality(df, labels).collect()} == {1: len(words), 2: 202, 3: 1}
    assert toxicity.toxicity(df, labels).count() == 3


def test_materialized_tables_are_discarded_and_the_folder_is_checked(spark):
    df = common.materialize(spark.range(5), "some")
    assert df.count() == 5
    common.discard(df, None)
    path = spark._jvm.org.apache.hadoop.fs.Path(df.folder)
    assert not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)

    class Cluster:
        class conf:  # noqa: N801
            get = staticmethod(lambda *_: None)

        class sparkContext:  # noqa: N801
            master = "spark://host:7077"

    with pytest.raises(RuntimeError):
        common.shared_dir(Cluster)
