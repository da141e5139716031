"""The ten operators and the pipeline against brute force on a small table with awkward rows."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from millrace.llm import bpe, langid, media, mixing, near_dedup, quality, secrets, substring_dedup, suffix_dedup, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, did string, spans string, h int, taken int"


def texts():
    r = random.Random(4)
    vocabulary = ["".join(r.choice("etaoinshr") for _ in range(r.randint(2, 7))) for _ in range(300)]
    make = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    base, passage = make(150), make(60)
    near = base.split()
    near[70] = "changed"
    out = [base, base, " ".join(near), make(40) + " " + passage + " " + make(30), passage + "\n" + make(50), make(20) + " " + passage, "", None, "é 日本 👍", "aaaa" * 200, "x " * 120]
    out += [make(100) + ' token = "' + "0a1b2c3d4e" * 4 + '" ' + make(10), make(400) + " " + base, "AKIA" + "A" * 16, "line\nline\n\nother line"]
    return out + [make(r.randint(1, 60)) for _ in range(20)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ("en", "de", None)[i % 3], (None, "b", "a", "")[i % 4], None, "x", "y", 1, 2) for i, t in enumerate(texts())]
    rows += [rows[0], (None, "null id", None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def data(docs):
    return [(r["doc_id"], (r["text"] or "").encode()) for r in docs.collect()]


def repeats_removed(rows):
    """What op1 has to return for (doc_id, bytes) rows."""
    seen = {}
    for _, t in rows:
        for i in range(len(t) - 199):
            seen[t[i : i + 200]] = seen.get(t[i : i + 200], 0) + 1
    want = []
    for d, t in rows:
        cover = bytearray(len(t))
        for i in range(len(t) - 199):
            if seen[t[i : i + 200]] > 1:
                cover[i : i + 200] = b"\1" * 200
        kept = bytes(b for b, c in zip(t, cover, strict=True) if not c)
        want.append((str(d), len(t), sum(cover), len(re.findall(b"\1+", bytes(cover))), hashlib.sha256(kept).hexdigest()))
    return sorted(want)


def test_suffix_dedup(docs, nothing):
    got = [(str(r[0]), *r[1:5]) for r in suffix_dedup.remove_repeats(docs).collect()]
    want = repeats_removed(data(docs))
    assert sorted(got) == want and any(w[2] for w in want)
    assert suffix_dedup.remove_repeats(nothing).count() == 0


@pytest.mark.parametrize("key_blocks", [1, 3, 1000])
def test_suffix_dedup_with_hot_anchors(spark, key_blocks):
    """Passages of 120 to 400 bytes in many texts of their own words: anchors with many contents, dealt to longer keys."""
    r = random.Random(9)
    make = lambda n: "".join(r.choice("etaoin shr") for _ in range(n))
    passages = [make(n) for n in (120, 160, 195, 200, 230, 400)]
    rows = [(i, make(r.randint(0, 150)) + p + make(r.randint(0, 150))) for i, p in enumerate(passages * 12)]
    rows += [(100 + i, passages[3][: 150 + i] + "z" + make(30)) for i in range(12)] + [(0, rows[0][1]), (7, rows[1][1])]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), key_blocks=key_blocks).collect()
    assert sorted((str(x[0]), *x[1:5]) for x in got) == repeats_removed([(d, t.encode()) for d, t in rows])


def test_deep_shallow_sorts():
    import numpy as np

    r = random.Random(1)
    buf = bytes(r.choice(b"ab") for _ in range(40)) * 12 + bytes(r.choice(b"abc") for _ in range(200))
    starts = np.arange(len(buf) - 60)
    for shallow in (8, 16, 20, 60):
        order, group = suffix_dedup.deep_shallow(np.frombuffer(buf, np.uint8), starts, 60, shallow)
        keys = [buf[i : i + 60] for i in starts[order]]
        assert keys == sorted(keys)
        assert [k for k in range(1, len(keys)) if keys[k] == keys[k - 1]] == [k for k in range(1, len(keys)) if group[k] == group[k - 1]]


@pytest.mark.parametrize("broadcast_cells", [substring_dedup.BROADCAST_CELLS, 0])
def test_substring_dedup(docs, nothing, broadcast_cells):
    seen, want = {}, {}
    for d, t in sorted(data(docs), key=lambda x: (x[0] is not None, x[0] or 0)):
        words = WORD.findall(t.decode())
        cover = [False] * len(words)
        for i in range(len(words) - 19):
            key = tuple(words[i : i + 20])
            if seen.setdefault(key, (d, i)) != (d, i):
                cover[i : i + 20] = [True] * 20
        kept = " ".join(w for w, c in zip(words, cover, strict=True) if not c)
        want.setdefault(d, set()).add((len(words), sum(cover), hashlib.sha256(kept.encode()).hexdigest()))
    got = substring_dedup.remove_earlier_windows(docs, broadcast_cells=broadcast_cells).collect()
    assert all(tuple(r)[1:4] in want[r["doc_id"]] for r in got) and len(got) == docs.count()
    assert sum(r["n_removed"] for r in got) > 100
    assert substring_dedup.remove_earlier_windows(nothing, broadcast_cells=broadcast_cells).count() == 0


def test_word_pieces_have_the_runs_of_whole_texts():
    r = random.Random(10)
    make = lambda n: " ".join(r.choice(["a", "bc", "def", "ghij"]) for _ in range(n))
    some = [make(500).encode(), b"", b"x" * 3000, (make(300) + "\n\t " + make(200) + " ").encode(), b" " * 500, make(21).encode()]
    windows = lambda size: sorted((int(o), int(s) + k) for o, s, n in zip(*(lambda x: (x[0], x[1]["start"], x[1]["n"]))(substring_dedup.word_runs(some, size)), strict=True) for k in range(n))
    assert windows(97) == windows(1 << 20) == [(i, k) for i, t in enumerate(some) for k in range(len(t.split()) - 19)]


def test_byte_bpe(docs, nothing):
    import public_tokenizers
    import tiktoken

    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    c = bpe.Codec.load(path, pattern)
    whole = tiktoken.Encoding("w", pat_str=pattern, mergeable_ranks={b: i for i, b in enumerate(c.bytes_of)}, special_tokens={})
    for d, n, ids, back in bpe.encode_documents(docs.filter("doc_id is not null"), path, pattern).collect():
        t = texts()[d] or ""
        e = whole.encode_ordinary(t)
        assert (n, ids, back) == (len(e), hashlib.sha256(" ".join(map(str, e)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
    for leaf_bytes in (1, 3, 16):
        c.leaf_bytes, c.known, c.older = leaf_bytes, {}, {}
        r = random.Random(leaf_bytes)
        for t in ["a" * 5000, "日本語中文字" * 300, "ab" * 999 + "é" * 50, "." * 700, " " * 900 + "x", *("".join(r.choice("etaoinshrdlu日é") for _ in range(r.randint(1, 300))) for _ in range(150))]:
            assert c.encode(t) == whole.encode_ordinary(t), t
    c.leaf_chars, c.known = 5, {}
    r = random.Random(2)
    for k in range(600):
        t = "".join(r.choice(r.choice(["ab ", "é'ts re", " \n\t", "0129", "the q"])) for _ in range(r.randint(0, 90)))
        assert c.encode(t) == whole.encode_ordinary(t), t
    assert bpe.encode_documents(nothing, path, pattern).count() == 0


def test_language_id(spark, docs, nothing):
    r = random.Random(3)
    words = {"en": ["the", "with", "that", "house"], "de": ["und", "schön", "ich", "häuser"]}
    rows = [(i, " ".join(r.choice(words[k]) for _ in range(20)), k) for i in range(80) for k in (("en", "de")[i % 2],)] + [(100, None, "en"), (101, "12 !", "en"), (102, "", None)]
    got = {x["doc_id"]: x for x in langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(got[i]["lang_pred"] == k and 0 <= got[i]["score"] <= 1 for i, _, k in rows[:80])
    assert [got[i]["lang_pred"] for i in (100, 101, 102)] == ["und"] * 3
    assert all(x["held_out"] == (zlib.crc32(str(x["doc_id"]).encode()) % 4 == 2) for x in got.values())
    assert langid.identify(docs).count() == docs.count() and langid.identify(nothing).count() == 0


def test_media(docs, nothing):
    for d, n, p, sha, tail, m, msha, feature, tensor, shape, stored in media.media_column(docs, keep=True).collect():
        frame = media.decode(bytes(stored), fast=False)
        back = media.payload_of(frame)
        assert hashlib.sha256(back).hexdigest() == sha and len(back) == p and p % 64 == 0 < p and zlib.crc32(back[-64:]) == tail
        assert len(stored) == m and len(tensor) == shape[0] * shape[1] * 3 and media.rgb(frame).tobytes() == bytes(tensor)
        if d is not None:
            t = (texts()[d] or "").encode()
            assert back == media.pad(t) and n == len(t)
    assert media.media_column(nothing).count() == 0


def test_media_pixels_by_the_definition():
    """Inverse DCT and chroma upsampling against sums over all coefficients, pixel by pixel."""
    import math

    import numpy as np

    frame = media.decode(media.encode(media.pad(bytes(random.Random(11).randrange(256) for _ in range(700)))))
    got = media.rgb(frame)
    zigzag = media.ZIGZAG.tolist()
    scale = lambda k: math.sqrt(0.5) if k == 0 else 1.0

    def sample(c, y, x):
        block = frame.planes[c][y // 8, x // 8]
        return sum(scale(z // 8) * scale(z % 8) / 4 * int(block[k]) * math.cos((2 * (y % 8) + 1) * (z // 8) * math.pi / 16) * math.cos((2 * (x % 8) + 1) * (z % 8) * math.pi / 16) for k, z in enumerate(zigzag))

    for y, x in [(0, 0), (3, 9), (15, 15), (7, 12), (got.shape[0] - 1, got.shape[1] - 1), (8, 1), (1, 8)]:
        luma, cb, cr = sample(0, y, x) + 128, sample(1, y // 2, x // 2), sample(2, y // 2, x // 2)
        want = [luma + 1.402 * cr, luma - 0.344136 * cb - 0.714136 * cr, luma + 1.772 * cb]
        assert all(abs(int(g) - min(255, max(0, w))) <= 1 for g, w in zip(got[y, x], want, strict=True))
    assert got.dtype == np.uint8 and zigzag[:6] == [0, 1, 8, 16, 9, 2]


def test_toxicity(spark, docs, nothing):
    r = random.Random(5)
    clean = ["house", "river", "garden", "window", "letter", "music"]
    rows = []
    for i in range(400):
        w = [r.choice(clean) for _ in range(12)]
        if i % 4 == 0:
            w[r.randrange(12)] = "grobnik"
        rows.append((i, " ".join(w)))
    d = spark.createDataFrame([*rows, (900, "house gr0bn1k river"), (901, "river g r o b n i k house"), (902, "house grobniiiik river"), (903, "river house garden"), (904, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)] + [(None, 1), (5, None)], "doc_id long, toxic int")
    got = {x["doc_id"]: x for x in toxicity.toxicity(d, labels).collect()}
    assert [got[i]["predicted"] for i in (900, 901, 902, 903, 904)] == [1, 1, 1, 0, 0]
    assert sum(got[i]["predicted"] == (i % 4 == 0) for i in range(400)) > 395
    assert toxicity.toxicity(docs, labels.limit(0)).count() == docs.count() and toxicity.toxicity(nothing, labels).count() == 0


def targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, free, left = {}, set(names), 1.5 * sum(sizes.values())
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 2 * sizes[s]}
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 2 * sizes[s]
            left -= target[s]
        free -= over
    return target


def test_mixing(docs, nothing):
    got = mixing.mix_sources(docs).collect()
    sizes = {}
    for r in docs.collect():
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(WORD.findall(r["text"] or ""))
    target = targets(sizes)
    assert all(abs(r["target"] - target[r["source"]]) < 1e-6 and r["source_size"] == sizes[r["source"]] and 0 <= r["taken"] <= 2 * r["size"] for r in got)
    for s in sizes:
        assert abs(sum(r["taken"] for r in got if r["source"] == s) - target[s]) <= 1
    assert sorted(map(str, mixing.mix_sources(docs).collect())) == sorted(map(str, got))
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert abs(sum(len(WORD.findall(r["text"] or "")) for r in mixed.collect()) - sum(target.values())) <= len(sizes) + 2
    assert mixing.mix_sources(nothing).count() == 0 and mixing.mixed_documents(nothing).count() == 0


def near_classes(by_id):
    """The least id of each id's class, by all pairs."""

    def shingles(x):
        w = WORD.findall(x or "")
        return [tuple(w[i : i + 5]) for i in range(len(w) - 4)]

    parent = {i: i for i in by_id}
    find = lambda x: x if parent[x] == x else find(parent[x])
    grams = {i: shingles(t) for i, t in by_id.items()}
    for a in by_id:
        for b in by_id:
            if b < a and ((by_id[a] or "") == (by_id[b] or "") or near_dedup.similarity(grams[a], grams[b]) >= 0.8):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in by_id}


def test_near_dedup(docs, nothing):
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.near_duplicates(docs.filter("doc_id is not null")).collect()}
    classes = near_classes(dict(enumerate(texts())))
    assert got == classes and got[1] == got[2] == 0
    kept = near_dedup.deduplicate(docs)
    assert kept.columns == docs.columns and kept.filter("doc_id in (0, 1, 2)").count() == 1
    assert near_dedup.near_duplicates(nothing).count() == 0


def test_banded_alignment():
    r = random.Random(6)
    for _ in range(300):
        a, b = ([r.randrange(6) for _ in range(r.randint(0, 25))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert near_dedup.aligned(a, b, 99) == table[-1][-1]


def test_secrets(spark, docs, nothing):
    cases = ['api_key: "abcdef12" x', "é Token=abc", "password: secret=abc123x", "AKIA" + "Z" * 16, "AKIA" + "Z" * 15, "f" * 23, "zz" + "f" * 24, None, ""]
    d = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in secrets.scan_secrets(d).collect()}
    assign = re.compile(secrets.ASSIGN.pattern.decode(), re.I | re.A)
    for i, t in enumerate(cases):
        t = t or ""
        spans = [("assign", m) for m in assign.finditer(t) if len(m[2]) >= 6]
        spans += [("access", m) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20] + [("hex", m) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        spans.sort(key=lambda s: (s[1].start(), ("assign", "access", "hex").index(s[0])))
        line = ",".join(f"{k}:{m.start()}:{m.end()}" for k, m in spans)
        assert got[i]["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
    clean = secrets.redact(docs)
    assert clean.columns == docs.columns and clean.filter(F.col("text").contains("0a1b2c3d4e")).count() == 0
    assert clean.filter("text is null").count() == docs.filter("text is null").count()
    assert secrets.scan_secrets(nothing).count() == 0


def test_quality(spark, docs, nothing):
    labels = spark.createDataFrame([(0, 1), (1, 0), (None, 0), (2, None)], "doc_id long, quality int")
    for r in quality.quality(docs.filter("doc_id is not null"), labels).collect():
        t = texts()[r["doc_id"]] or ""
        w = WORD.findall(t)
        windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
        cover = {k for i, x in enumerate(windows) if windows.count(x) > 1 for k in range(i, i + 8)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        want = (len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(cover))
        assert tuple(r)[1:6] == want
        assert r["base_failed"] == (len(w) < 20 or 100 * len(cover) > 30 * len(w)) and not (r["base_failed"] and r["kept"])
    assert quality.quality(nothing, labels).count() == 0


def test_decision_list_learns_a_conjunction():
    r = random.Random(7)
    rows = []
    for i in range(600):
        s = {f: r.random() for f in quality.FEATURES}
        rows.append((s, 0 if s["symbol_share"] > 0.7 and s["words"] < 0.5 else 1, i % 3))
    rules = quality.learn(rows)
    bad = lambda s: any(all(c.holds(s) for c in rule) for rule in rules.rules)
    assert sum(bad(s) == (not g) for s, g, _ in rows) > 590


def test_pipeline(spark, tmp_path):
    """Every stage against brute force on its own input, and run() against the stages."""
    import corpus_pipeline
    import public_tokenizers
    import tiktoken

    r = random.Random(8)
    vocabulary = ["".join(r.choice("etaoinshr") for _ in range(r.randint(3, 7))) for _ in range(200)]
    make = lambda n: [r.choice(vocabulary) for _ in range(n)]
    key = "0a1b2c3d4e" * 4
    rows = {i: make(40) for i in range(300)}
    for i in range(0, 300, 4):
        rows[i][r.randrange(40)] = "grobnik"
    rows[300] = [*make(20), "gr0bn1k", *make(20)]
    rows |= {301: make(150), 302: make(150), 303: [*make(10), f"token={key}", *make(10)]}
    rows[304], rows[305], rows[306] = [*rows[301][:70], "changed", *rows[301][71:]], rows[302], rows[1]
    docs = [(i, " ".join(w), "en", ("big", "big", "small")[i % 3], 0, "extra") for i, w in rows.items()] + [(400, None, None, None, None, None), (401, "", "en", "small", 0, None)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long, taken string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(300)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    sf_dir = str(tmp_path)

    step, kept = spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    columns = step.columns
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, step, sf_dir)
        out.write.parquet(f"{sf_dir}/{name}")
        step = spark.read.parquet(f"{sf_dir}/{name}")
        kept[name] = step.collect()
        assert name == "tokens" or step.columns == columns
    ids = lambda name: [x["doc_id"] for x in kept[name]]
    toxic = {i for i, w in rows.items() if {"grobnik", "gr0bn1k"} & set(w)}
    assert sorted(ids("toxicity")) == sorted({x[0] for x in docs} - toxic)
    assert {tuple(x) for x in kept["toxicity"]} <= set(docs)

    classes = near_classes({x["doc_id"]: x["text"] for x in kept["toxicity"]})
    assert sorted(ids("near_dedup")) == sorted(set(classes.values())) and classes[304] == 301 and classes[306] == 1
    assert {tuple(x) for x in kept["near_dedup"]} <= set(docs)

    before = {x["doc_id"]: x["text"] for x in kept["near_dedup"]}
    assert sorted(ids("secrets")) == sorted(before)
    for x in kept["secrets"]:
        assert x["text"] == (before[x["doc_id"]] if x["doc_id"] != 303 else before[303].replace(f"token={key}", "[secret]"))

    sizes, taken = {}, {}
    for name, count in (("secrets", sizes), ("mixing", taken)):
        for x in kept[name]:
            count[x["source"]] = count.get(x["source"], 0) + len(WORD.findall(x["text"] or ""))
    assert all(abs(taken.get(s, 0) - t) <= 1 for s, t in targets(sizes).items())
    assert max(ids("mixing").count(i) for i in ids("mixing")) <= 2

    c = bpe.Codec.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    whole = tiktoken.Encoding("w", pat_str=public_tokenizers.PATTERN, mergeable_ranks={b: i for i, b in enumerate(c.bytes_of)}, special_tokens={})
    want = []
    for x in kept["mixing"]:
        e = whole.encode_ordinary(x["text"])
        want.append((x["doc_id"], len(e), hashlib.sha256(" ".join(map(str, e)).encode()).hexdigest(), hashlib.sha256(x["text"].encode()).hexdigest()))
    assert sorted(tuple(x)[:4] for x in kept["tokens"]) == sorted(want)
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).collect())) == sorted(map(tuple, kept["tokens"]))


def test_substring_long_words_of_equal_polynomial_hash(spark):
    same, words = ["w"] * 19, ["".join("ab"[(i.bit_count() + f) % 2] for i in range(n)) for n in (1024, 2048, 4096) for f in range(2)]
    rows = [(k, " ".join([*same, w])) for k, w in enumerate(words)]
    assert all(r.n_removed == 0 for r in substring_dedup.remove_earlier_windows(spark.createDataFrame(rows, "doc_id long, text string")).collect())
