"""Order MinHash: recall against all pairs, links between texts that are both linked already, shared boilerplate."""

import random

import numpy as np

from millrace.llm import common, near_dedup


def shingles(text):
    w = text.split()
    return [tuple(w[i : i + 5]) for i in range(len(w) - 4)]


def alignment(a, b):
    """Longest common subsequence by the whole table."""
    row = [0] * (len(b) + 1)
    for x in a:
        last = row
        row = [0]
        for j, y in enumerate(b):
            row.append(last[j] + 1 if x == y else max(last[j + 1], row[j]))
    return row[-1]


def linked(a, b):
    """Aligned shingles over all shingles, without the operator's own code."""
    x, y = shingles(a), shingles(b)
    if not x or not y or min(len(x), len(y)) < 0.8 * max(len(x), len(y)):
        return False
    got = alignment(x, y)
    return got >= 0.8 * (len(x) + len(y) - got) - 1e-9


def classes_of(texts):
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = 0
    for i in range(len(texts)):
        for j in range(i):
            if texts[i] == texts[j] or linked(texts[i], texts[j]):
                links += 1
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(texts))], links


def test_link_between_closed_members_of_different_leaders(spark):
    # A (110 k-mers) and B (92) share 90, B and C (91) share 89, A and C 89: A-B and B-C are links, A-C isn't.
    def key(name):
        return bytearray(name.encode())

    w, t = [f"w{i}" for i in range(94)], [f"t{i}" for i in range(20)]
    texts = {"A": [*w, *t], "B": [*w, "b1", "b2"], "C": [*w[1:], "c1", "c2"], "D": [*w[:92], *t]}
    texts = {k: " ".join(v) for k, v in texts.items()}
    pairs = {(a, b) for a in texts for b in texts if a < b and linked(texts[a], texts[b])}
    assert ("A", "B") in pairs and ("B", "C") in pairs and ("A", "D") in pairs and ("A", "C") not in pairs
    frame = spark.createDataFrame([(key(k), v) for k, v in texts.items()], "tkey binary, text string")
    sigs = spark.createDataFrame([(key(k), bytearray(near_dedup.sketches([v.encode()])[2].tobytes())) for k, v in texts.items()], "tkey binary, signature binary")
    # D and A were linked in a round before; in the rare bucket C leads, so B is closed by C and A from the start.
    known = spark.createDataFrame([(key("A"), key("D"), True)], "a binary, b binary, linked boolean")
    size = {k: len(shingles(v)) for k, v in texts.items()}
    state = spark.createDataFrame([(1, key(k), size[k], 99, (size[k], i), k in "BC") for i, k in enumerate("CBA")], "bucket long, tkey binary, n int, rest long, order struct<n:int,o:int>, open boolean")
    found, _ = near_dedup.leader_rounds(state, sigs, frame, [known], 0.8, None)
    by_leaders = {(bytes(r["a"]), bytes(r["b"])) for r in near_dedup.union(found).filter("linked").collect()}
    assert by_leaders == {(b"A", b"D"), (b"B", b"C")}  # the loss
    found = near_dedup.across_classes(state, sigs, frame, found, 0.8)
    assert {(bytes(r["a"]), bytes(r["b"])) for r in near_dedup.union(found).filter("linked").collect()} == by_leaders | {(b"A", b"B")}
    assert len({bytes(r["comp"]) for r in near_dedup.components(near_dedup.union(found).filter("linked")).collect()}) == 1


def test_links_are_named_as_those_verified(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f")], "doc_id long, text string")
    got = near_dedup.near_duplicates(docs)
    assert "n_verified_links" in got.columns and "n_links" not in got.columns


def test_recall_around_the_threshold(spark):
    """Edited copies on both sides of 0.8, short texts and a shared passage: classes of all pairs."""
    r = random.Random(21)
    make = lambda n: [f"{r.choice('abcdefgh')}{r.randrange(400)}" for _ in range(n)]
    passage, texts = make(60), []
    for k in range(30):
        base = make(r.choice([6, 8, 12, 30, 90, 200]))
        texts.append(base)
        for _ in range(5):
            near = list(base)
            for _ in range(r.randint(1, max(1, len(base) // 60))):
                at = r.randrange(len(near))
                near[at : at + 1] = r.choice([[], make(1), make(2)])
            texts.append(near)
        if k % 2:
            texts.append([*make(r.randint(5, 30)), *passage, *make(r.randint(0, 20))])
    texts = [" ".join(t) for t in texts]
    want, links = classes_of(texts)
    got = {x["doc_id"]: x["class_id"] for x in near_dedup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [got[i] for i in range(len(texts))] == want and links > 30


def test_boilerplate_is_not_aligned_with_everything(spark):
    """Texts of 16 out of 20 shared paragraphs: what is aligned follows the links, not all pairs."""
    r = random.Random(22)
    paragraphs = [[f"p{i}x{r.randrange(9999)}" for _ in range(15)] for i in range(20)]
    texts = [" ".join(w for i in sorted(r.sample(range(20), 16)) for w in paragraphs[i]) for _ in range(80)]
    pairs = [(a, b) for i, a in enumerate(texts) for b in texts[:i]]
    kmers = [[near_dedup.kmers_of([t.encode()])[0].tolist() for t in p] for p in pairs]
    aligned = []
    real = near_dedup.aligned
    near_dedup.aligned = lambda a, b, band: aligned.append(1) or real(a, b, band)
    try:
        found = [near_dedup.similarity(a, b) >= 0.8 for a, b in kmers]
    finally:
        near_dedup.aligned = real
    assert found == [linked(a, b) for a, b in pairs] and len(aligned) <= sum(found) + len(texts)


def test_banded_alignment_in_narrow_bands():
    r = random.Random(23)
    for _ in range(300):
        a, b = ([r.randrange(5) for _ in range(r.randint(0, 18))] for _ in range(2))
        band = r.randint(0, 5)
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y and abs(i - j) <= band else max(table[i][j + 1], table[i + 1][j])
        lead = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        got = near_dedup.aligned(a, b, band)
        assert got <= alignment(a, b) and got >= table[-1][-1] and got >= lead


def test_signatures_pass_what_is_similar():
    r = random.Random(24)
    make = lambda n: [f"w{r.randrange(10**6)}" for _ in range(n)]
    lost = passed = 0
    for _ in range(150):
        base = make(150)
        near = [*base[:133], *make(17)]  # 129 of 163 shingles: just below 0.8
        far = [*base[:60], *make(90)]
        x, y, z = near_dedup.sketches([" ".join(t).encode() for t in (base, near, far)])[2]
        ok = lambda p, q: ((p == q) & (p > 0)).sum() >= 0.8 * (f := ((p > 0) | (q > 0)).sum()) - near_dedup.DEVIATIONS * np.sqrt(0.16 * f)
        lost += not ok(x, y)
        passed += ok(x, z)
    assert lost == 0 and passed < 5


def edited(r, words, changes):
    """The words with so many of them replaced, far apart."""
    out = list(words)
    for i in r.sample(range(0, len(words), 6), changes):
        out[i] = f"new{i}"
    return out


def test_pairs_just_above_the_threshold_share_a_sketch():
    r, texts = random.Random(11), []
    while len(texts) < 2 * 1500:
        n = r.choice([60, 150, 300, 500])
        a = [f"w{r.randrange(30_000)}" for _ in range(n)]
        b = edited(r, a, int((n - 4) * 0.0215) + r.randint(0, 1))
        s = near_dedup.similarity(*(k.tolist() for k in near_dedup.kmers_of([" ".join(x).encode() for x in (a, b)])))
        if 0.8 <= s <= 0.83:
            texts += [" ".join(a).encode(), " ".join(b).encode()]
    _, buckets, _ = near_dedup.sketches(texts)
    assert sum(not np.isin(a, b).any() for a, b in zip(buckets[::2], buckets[1::2], strict=True)) == 0


def thue_morse(n, flip=0):
    return "".join("ab"[(i.bit_count() + flip) % 2] for i in range(n))


def test_long_words_of_equal_polynomial_hash_are_different_texts(spark):
    rows = [(2 * k + f, " ".join([thue_morse(n, f)] * 7)) for k, n in enumerate((1024, 2048, 4096)) for f in range(2)]
    out = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r.class_id == r.doc_id for r in out)


def test_intermediate_tables_are_deleted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "shared_dir", lambda _: f"file://{tmp_path}")
    r = random.Random(3)
    common_words = [f"c{i}" for i in range(60)]
    rows = [(k, " ".join([*common_words, *(f"w{r.randrange(10**6)}" for _ in range(25))])) for k in range(40)]
    near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir()] == ["near-rows"]


def test_texts_of_one_class_are_not_compared_again(spark, monkeypatch):
    r = random.Random(31)
    base = [f"w{r.randrange(10**6)}" for _ in range(120)]
    texts = [" ".join(edited(r, base, r.choice([1, 2, 3]))) for _ in range(40)] + [" ".join([*base[:60], *(f"v{r.randrange(10**6)}" for _ in range(60))]) for _ in range(12)]
    real, calls = near_dedup.verified, []

    def watched(pairs, sigs, frame, threshold):
        out = real(pairs, sigs, frame, threshold)
        calls.append([(bytes(x["a"]), bytes(x["b"]), x["linked"]) for t in out for x in t.collect()])
        return out

    monkeypatch.setattr(near_dedup, "verified", watched)
    got = {x["doc_id"]: x["class_id"] for x in near_dedup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    want, links = classes_of(texts)
    assert [got[i] for i in range(len(texts))] == want and links > 100
    root = {}

    def find(x):
        while root.get(x, x) != x:
            x = root[x]
        return x

    for call in calls:
        assert not [1 for a, b, _ in call if find(a) == find(b)]
        for a, b, linked_ in call:
            if linked_:
                root[find(a)] = find(b)
    assert len(calls) > 1


def group_around_the_threshold():
    """Copies with three words of their own each: of 0.64 to each other, of 0.8 or more to those few with less."""
    r = random.Random(41)
    base = [f"w{r.randrange(10**6)}" for _ in range(150)]
    texts = []
    for k in range(50):
        near = list(base)
        for i in r.sample(range(0, 150, 5), 1 + k % 2 if k < 6 else 3):
            near[i] = f"own{k}x{i}"
        texts.append(" ".join(near))
    return texts


def test_parities_rule_out_pairs_and_never_a_link(spark, monkeypatch):
    """Of the pairs between classes of one group of copies few are asked beside the links, and classes stay those of all pairs."""
    texts = group_around_the_threshold()
    real, asked = near_dedup.class_pairs, []

    def watched(*args):
        out = real(*args)
        asked.extend((bytes(x["a"]), bytes(x["b"])) for x in out.collect())
        return out

    monkeypatch.setattr(near_dedup, "class_pairs", watched)
    got = {x["doc_id"]: x["class_id"] for x in near_dedup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    want, links = classes_of(texts)
    assert [got[i] for i in range(len(texts))] == want and len(set(want)) > 10 and links > 20
    apart = sum(want[i] != want[j] for i in range(len(texts)) for j in range(i))
    assert len(asked) == len(set(asked)) and len(asked) < apart / 10


def test_parities_differ_in_no_more_bits_than_texts_in_kmers():
    r = np.random.default_rng(42)
    for n, far in [(0, 0), (1, 1), (60, 12), (800, 90), (5000, 4000)]:
        a = r.integers(0, 1 << 63, n, np.uint64)
        b = np.concatenate([a[far // 2 :], r.integers(0, 1 << 63, far - far // 2, np.uint64)])
        x, y = near_dedup.parities(a), near_dedup.parities(b)
        assert len(x) == near_dedup.BITS // 64
        assert np.bitwise_count(x.view(np.uint64) ^ y.view(np.uint64)).sum() <= far  # far // 2 left out, the others new


def test_rounds_of_leaders_with_parities_find_the_same_classes(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "MEETINGS", 0)
    texts = group_around_the_threshold()
    got = {x["doc_id"]: x["class_id"] for x in near_dedup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [got[i] for i in range(len(texts))] == classes_of(texts)[0]
