"""Three operators against their definitions, written out without the operators' own shortcuts."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import langid, mixing, toxicity


def profile(text, dimension):
    """The bundle of a text by the definition: letters in lower case, one space for each run of anything else."""
    seen = ""
    for c in text.lower():
        seen += c if c.isalpha() else "" if seen.endswith(" ") else " "
    if not seen.endswith(" "):
        seen += " "
    total = np.zeros(dimension)
    for a, b, c in zip(seen, seen[1:], seen[2:]):
        if b != " ":
            x, y, z = (langid.letter_vector(ord(k), dimension) for k in (a, b, c))
            total += [int(x[(i - 2) % dimension]) * int(y[(i - 1) % dimension]) * int(z[i]) for i in range(dimension)]
    return total


def test_profiles_by_definition(spark):
    r = random.Random(11)
    letters = {"en": "etaoin shrdlu", "de": "enisra tüöäß", "ja": "日本語の文 で"}
    rows = [(i, "".join(r.choice(letters[k]) for _ in range(r.randint(0, 60))) + r.choice(["", "!", " 12"]), k) for i in range(60) for k in (list(letters)[i % 3],)]
    rows += [(100, "ab", None), (101, "é", "en"), (102, "", "de"), (103, None, "en"), (104, "12", "de"), rows[0]]
    taught = {}
    for i, text, lang in rows:
        if lang and text is not None:
            taught[lang] = taught.get(lang, np.zeros(128)) + profile(text, 128)
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.train(d, dimension=128)
    assert got.keys() == taught.keys() and all(np.allclose(got[k], taught[k]) for k in got)
    names = sorted(taught)
    for x in langid.predict(d, got).collect():
        text = next(t for i, t, _ in rows if i == x["doc_id"]) or ""
        if not any(c.isalpha() for c in text):
            assert (x["lang_pred"], x["score"]) == ("und", 0)
            continue
        v = profile(text, 128)
        cosines = [float(v @ taught[k] / max(1e-12, np.linalg.norm(v) * np.linalg.norm(taught[k]))) for k in names]
        assert cosines[names.index(x["lang_pred"])] > max(cosines) - 1e-5
        assert abs(x["score"] - min(1, max(0, *cosines))) < 1e-5


def test_viterbi_by_every_path_of_the_lattice():
    corpus = ["you are a loser and an idiot", "what a stupid idea it is", "worthless trash and hate", "the house and the river"] * 20
    d = toxicity.Decoder(toxicity.char_costs(toxicity.gram_counts([t.encode() for t in corpus])))

    def total(path):
        ctx, cost = 0, 0.0
        for letter, channel in path:
            cost += channel
            if letter == " ":
                cost += d.table[ctx][0]
                ctx = 0
            elif letter:
                k = ord(letter) - 96 if "a" <= letter <= "z" else 27
                cost += d.table[ctx][k]
                ctx = (ctx * toxicity.K + k) % toxicity.K**3
        return cost + d.table[ctx][0]

    seen = ["l0s3r", "1d10t", "hat3", "l*ser", "i*", "st**", "a l o s", "7r4$h", "riiver", "looser", "hhhate", "!d!0t", "wh4t!", "é1a", "l.0.s", "+ra5h"]
    for word in seen:
        best = {}
        for path in itertools.product(*d.readings(word)):
            text = " ".join("".join(x for x, _ in path).split())
            best[text] = min(best.get(text, np.inf), total(path))
        assert best[d.decode(word)] < min(best.values()) + 1e-4, (word, d.decode(word), min(best, key=best.get))


@pytest.mark.parametrize("range_rows", [1, 7, 1 << 15])
def test_taken_by_order_of_keys(spark, range_rows):
    r = random.Random(12)
    rows = [(i, "w " * r.randint(0, 30), r.choice(["a", "a", "a", "b", "c", None])) for i in range(120)]
    rows += [rows[3], rows[3], (None, "x y z", "a"), (None, "x y z", "a"), (500, None, "b")]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    keyed = d.withColumn("key", F.xxhash64(F.lit(17), "doc_id", "text")).collect()
    got = mixing.mix_sources(d, range_rows=range_rows).collect()
    target = {x["source"]: x["target"] for x in got}
    want = []
    for s in target:
        own = sorted((x for x in keyed if x["source"] == s), key=lambda x: (x["key"], x["doc_id"] is None, x["doc_id"] or 0))
        sizes = [len((x["text"] or "").split()) for x in own]
        left = [int(target[s] + 1e-9)]
        taken = [0] * len(own)
        while left[0] and sum(sizes):  # epoch by epoch, word by word of each document
            for i, n in enumerate(sizes):
                taken[i] += min(n, left[0])
                left[0] -= min(n, left[0])
        want += [(str(x["doc_id"]), str(s), n, t) for x, n, t in zip(own, sizes, taken, strict=True)]
    assert sorted((str(x["doc_id"]), str(x["source"]), x["size"], x["taken"]) for x in got) == sorted(want)
