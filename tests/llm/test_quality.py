"""Rules learned from a capped sample against those of all labelled rows."""

from millrace.llm import quality


def test_precision_is_that_of_all_labels_above_the_cap(spark, monkeypatch):
    words = " ".join("ab" + chr(97 + i) for i in range(25))
    bad = lambda i: i % 11 == 0
    # Texts with a sign: all of the 120 bad ones and 1 in 14 of the 1,200 good ones, so 58 % of them are bad.
    d = spark.createDataFrame([(i, words + (" ####" if bad(i) or i % 14 == 1 else " abcd")) for i in range(1320)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(not bad(i))) for i in range(1320)], "doc_id long, quality int")
    assert quality.train(d, labels).rules == []
    monkeypatch.setattr(quality, "SAMPLE_PER_LABEL", 120)
    assert quality.train(d, labels).rules == []
