"""Disguised words by unit tests of the decoder; the classifier's sample against all rows."""

from millrace.llm import toxicity

CORPUS = ["you are a loser and an idiot", "what a stupid idea it is", "worthless trash and hate for a worthless idiot", "a loser is stupid", "i like the house and the river"] * 20


def decoder():
    return toxicity.Decoder(toxicity.char_costs(toxicity.gram_counts([t.encode() for t in CORPUS])))


def test_signs_anywhere_in_a_word():
    cases = {"hat3": "hate", "idio7": "idiot", "worthle55": "worthless", "worthle$$": "worthless", "l053r": "loser", "!diot": "idiot", "+rash": "trash", "|diot": "idiot", "idi07": "idiot", "8ut": "but", "a8out": "about", "idio*": "idiot", "h*t*": "hate", "l0s**": "loser"}
    d = decoder()
    for seen, word in cases.items():
        for text in (f"the house {seen} and river", seen, f"({seen.upper()})"):
            assert toxicity.noisy_texts([text.encode()]).all(), text
            if word not in ("but", "about"):  # not in the corpus
                assert word in d.words(text, True), (text, d.words(text, True))
            else:
                assert toxicity.NOISY.search(text.lower())[0] == seen
    assert d.restore("hat3 the l053r") == "hate the loser"


def test_noisy_texts_is_a_superset_of_the_pattern():
    import random

    r = random.Random(8)
    for _ in range(3000):
        text = "".join(r.choice("abbé 1256_!*+|$@.-x ") for _ in range(r.randint(1, 12)))
        assert not toxicity.NOISY.search(text.lower()) or toxicity.noisy_texts([text.encode()])[0], text


def test_stars_at_the_end_by_brute_force():
    d = decoder()
    for seen in ("hat*", "lo***", "st**", "i*", "wor****"):
        states = {0: (0.0, "")}
        for arcs in d.readings(seen):
            after = {}
            for ctx, (cost, path) in states.items():
                for letter, channel in arcs:
                    k = (ord(letter) - 96) if letter.strip() else 0
                    to, new = (0 if letter == " " else (ctx * toxicity.K + k) % toxicity.K**3, cost + channel + d.table[ctx][k]) if letter else (ctx, cost + channel)
                    if to not in after or new < after[to][0]:
                        after[to] = (new, path + letter)
            states = after
        assert d.decode(seen) == min((cost + d.table[ctx][0], path) for ctx, (cost, path) in states.items())[1].strip()


def test_spaced_words_beside_each_other():
    d = decoder()
    cases = {"you are a l o s e r": "loser", "s t u p i d i d i o t": "stupid idiot", "i l-0-s-3-r": "loser", "w.o.r.t.h.l.e.s.s t r a s h": "worthless trash", "what!idiot": "idiot", "idiot!!": "idiot", "**loser**": "loser", "st*pid": "stupid"}
    for text, words in cases.items():
        assert toxicity.noisy_texts([text.encode()])[0] and set(words.split()) <= d.words(text, True), (text, d.words(text, True))
    assert d.restore("you are a l o s e r") == "you are a loser"


def test_prior_is_that_of_all_labels_above_the_cap(spark, monkeypatch):
    rows = [(i, i % 11 == 0) for i in range(2200)]
    weak = lambda i, toxic: i // 11 % 2 == 0 if toxic else i % 10 == 0
    d = spark.createDataFrame([(i, "house river grobnik" if weak(i, t) else "house river garden") for i, t in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(t)) for i, t in rows], "doc_id long, toxic int")
    score = lambda: {r["text"]: r["toxic_score"] for r in toxicity.score(d, toxicity.learn_from(d, labels)).distinct().select("text", "toxic_score").collect()}["house river grobnik"]
    whole = score()
    monkeypatch.setattr(toxicity, "SAMPLE_PER_LABEL", 150)
    capped = score()
    assert 0.25 < whole < 0.42 and abs(capped - whole) < 0.12, (whole, capped)


def test_capitals_with_accents():
    d = decoder()
    assert d.words("RÉEUXRÉ Ächlich, ACHLICHÄ", False) == {"réeuxré", "ächlich", "achlichä"}


def test_only_the_restored_text_is_scored():
    d = decoder()
    assert d.words("hat3 the l053r, a l-o-s-e-r!", True) == {"hate", "the", "loser", "a"}


def test_words_that_only_toxic_texts_have_are_learned_first(spark, monkeypatch):
    # 40 words that toxic texts have somewhat more often must not fill the model before 3 that no clean text has.
    import random

    r = random.Random(6)
    weak, sure = [f"w{'abcdefghij'[k % 10]}{'klmn'[k // 10]}x" for k in range(40)], ["grobnik", "zulmak", "vortep"]
    rows = []
    for i in range(1200):
        toxic = i % 10 == 0
        words = [w for w in weak if r.random() < (0.5 if toxic else 0.2)] + ([sure[i // 10 % 3]] if toxic else [])
        rows.append((i, " ".join(["house", *words]), int(toxic)))
    d = spark.createDataFrame([x[:2] for x in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id long, toxic int")
    monkeypatch.setattr(toxicity, "VOCABULARY", 8)
    model = toxicity.train(d, labels)
    assert set(sure) <= set(model.weights) and len(model.weights) == 8
    got = {x.doc_id: x.toxic_score >= 0.5 for x in toxicity.score(d, model).collect()}
    assert sum(got[i] == bool(t) for i, _, t in rows) >= 0.99 * len(rows)
