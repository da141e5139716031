"""What the field of the secret scan learns from, and what it finds beyond the patterns."""

import random

from millrace.llm import planted, secrets


def plain(r, n):
    return " ".join("".join(r.choice("etaoinshrdlu") for _ in range(r.randint(2, 8))) for _ in range(n))


def test_texts_teach_from_all_of_their_words():
    r = random.Random(1)
    texts = [plain(r, 900).encode() for _ in range(60)]
    for t in texts:
        got = secrets.training_sequences(t)
        assert sum(len(tags) == secrets.STRETCH and not tags.any() for _, tags in got) == secrets.STRETCHES
        assert sum(tags.any() for _, tags in got) == secrets.PLANTED and len(got) == secrets.STRETCHES + secrets.PLANTED
    places = [p for t in texts for p in secrets.hash_places(t, 841, 3, 1)]
    assert min(places) < 100 and max(places) > 740
    many = b" ".join(b"token=abcdef%02d filler" % k for k in range(50))
    assert len(secrets.training_sequences(many)) <= secrets.MARKS
    assert secrets.hash_places(b"a", 2, 3, 1) == [0, 1] and secrets.training_sequences(b"") != [] and len(secrets.training_sequences(b"a b")) >= 1


def test_the_field_finds_secrets_that_no_pattern_has(spark):
    """15 shapes and four plain cases: at least 0.9 of them found, no span in texts of look-alikes only."""
    r = random.Random(2)
    learn = [plain(r, r.randint(30, 120)) for _ in range(300)]
    rows, secret_of = list(enumerate(learn)), {}
    for shape in planted.SHAPES:
        for _ in range(8):
            new, n = planted.with_secret(r, shape)
            text = plain(r, 25) + " " + " ".join(new) + " " + plain(r, 25)
            assert n == 1
            secret_of[len(rows)] = (text.index(new[-1]), text.index(new[-1]) + len(new[-1]))
            rows.append((len(rows), text))
    for new in ("password Kol7aru99x", "TOKEN ghp_16C7e42F292c6912E7710c838347Ae178B4a", "pwd mizu4402!", "bearer eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjM0In0.dozjgNryP4J3jVmNHl0w5N"):
        text = plain(r, 20) + " " + new + " " + plain(r, 20)
        secret_of[len(rows)] = (text.index(new.split()[1]), text.index(new) + len(new))
        rows.append((len(rows), text))
    clean = range(len(rows), len(rows) + 200)
    rows += [(i, plain(r, 20) + " " + " ".join(planted.alike(r)) + " " + plain(r, 20)) for i in clean]
    # In tables secrets are rare; a sixth of the texts, unlabelled, would teach that they are none.
    field = secrets.train(spark.createDataFrame([(t,) for t in learn], "text string"))
    got = {x["doc_id"]: [tuple(map(int, s.split(":")[1:])) for s in x["spans"].split(",") if s] for x in secrets.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string"), field).collect()}
    found = [any(a < hi and lo < b for a, b in got[i]) for i, (lo, hi) in secret_of.items()]
    wrong = sum(not (a < hi and lo < b) for i, (lo, hi) in secret_of.items() for a, b in got[i]) + sum(len(got[i]) for i in clean)
    assert sum(found) >= 0.9 * len(found) and all(found[-4:]), (sum(found), len(found))
    assert wrong <= 0.02 * len(found), wrong
    assert sum(len(got[i]) for i in range(300)) == 0


def test_redact_keeps_columns_of_any_name(spark):
    rows = [(1, "token=abcdef99 x", "g", None), (2, None, None, "y")]
    got = secrets.redact(spark.createDataFrame(rows, "doc_id long, text string, gone string, __null string")).collect()
    assert [tuple(x) for x in got] == [(1, "[secret] x", "g", None), (2, None, None, "y")]
