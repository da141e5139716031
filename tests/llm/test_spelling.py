"""Spelling variants: neighbourhoods by definition, the whole result by brute force, edge cases."""

import collections
import random
import re
import zlib

import numpy as np
import pytest

from millrace.llm import spelling


def edits(w, alphabet):
    out = {w[:i] + w[i + 1 :] for i in range(len(w))}
    out |= {w[:i] + c + w[i + 1 :] for i in range(len(w)) for c in alphabet}
    return (out | {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in alphabet}) - {w}


@pytest.mark.parametrize("held", [4, 1 << 17])
def test_neighbourhood_is_every_distinct_edit(monkeypatch, held):
    monkeypatch.setattr(spelling, "HELD", held)
    found, alphabet = ["aabba", "abcab", "cccccc", "éaéab", "a", ""], "abcé"
    got = list(spelling.neighbourhood(found, alphabet))
    assert len(got) == len(set(got))
    for k, w in enumerate(found[:5]):
        assert {x for i, x in got if i == k} == edits(w, alphabet)


def test_filter_never_drops_a_word():
    r = random.Random(4)
    found = sorted({"".join(r.choice("abéd") for _ in range(r.randint(5, 7))) for _ in range(300)})
    wanted = np.zeros(spelling.BITS // 8, np.uint8)
    for k in range(spelling.PROBES):
        bit = spelling.probe(spelling.Flat(found).whole, k)
        np.bitwise_or.at(wanted, (bit >> np.uint64(3)).astype(np.int64), np.left_shift(1, (bit & np.uint64(7)).astype(np.uint8)).astype(np.uint8))
    words = set(found)
    expected = {(k, x) for k, w in enumerate(found) for x in edits(w, "abéd") & words}
    got = list(spelling.neighbourhood(found, "abéd", wanted))
    assert expected <= set(got) and len(got) == len(set(got)) and len(got) <= len(expected) + 5


def brute(rows):
    count = collections.Counter()
    lower = str.maketrans(spelling.UPPER, spelling.LOWER)
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    n = {w: c for w, c in count.items() if len(w) >= 5 and c >= 3}
    alphabet = {c for w in n for c in w}
    near = {w: edits(w, alphabet) & set(n) for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        if best is not None and n[best] >= 2 * n[w]:
            form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return sorted(out, key=str)


def result(df):
    return sorted(map(tuple, spelling.spelling_variants(df).select("word", "form", "root", "n", "n_near", "form_n").collect()), key=str)


def test_whole_result_by_brute_force(spark):
    r = random.Random(7)
    words = ["".join(r.choice("abÉé") for _ in range(r.randint(4, 6))) for _ in range(60)]
    # Chains of forms: counts that double from word to word, and ties.
    text = ["stone " * 40 + "stones " * 20 + "stoness " * 10 + "stonesss " * 5 + "tones " * 5 + "Stone-ston " * 3, "alter alter alter altar altar altar " * 3]
    rows = [(k, " ".join(r.choice(words) + r.choice([" ", "-", "1", ", "]) for _ in range(80))) for k in range(40)]
    rows += [(100, text[0]), (101, text[1]), (101, text[1]), (None, "nulls nulls nulls nulla"), (102, None), (103, ""), (104, "x" * 300_000 + " ")]
    df = spark.createDataFrame([(*x, "clash", 1) for x in rows], "doc_id long, text string, word string, n int")
    expected = brute(rows)
    got = result(df)
    assert got == expected
    chain = {w: root for w, _, root, *_ in got}
    assert chain["stonesss"] == "stone" and chain["altar"] == "altar"


def test_very_long_runs(spark):
    a = "ab" * 20_000
    df = spark.createDataFrame([(k, f"{a} {a}c {a} {a}c {a} {a}") for k in range(2)], "doc_id long, text string")
    assert len(result(df)) == 2 and {x[4] for x in result(df)} == {1}


def test_nothing(spark):
    assert result(spark.createDataFrame([], "doc_id long, text string")) == []
    assert result(spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id long, text string")) == []
