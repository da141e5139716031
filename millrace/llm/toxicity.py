"""Toxicity of texts that may hide their words: a noisy channel, then a linear model.

Letters written as digits or signs, spaced out, starred or repeated form a
lattice of readings. Viterbi decoding under a character 4-gram model of the
whole corpus picks the likeliest one, and a logistic model scores the words of
the restored text. Words without such signs have one reading, themselves.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import CHUNK_BYTES, bytes_list, crc_mod, cuts, discard, materialize, rows_of

#: Characters of the language model: a boundary, a to z, any other letter.
ALPHABET = "^abcdefghijklmnopqrstuvwxyz~"
K = len(ALPHABET)
ORDER = 4
LEET = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t"}
SEPARATORS = " ._-*"
#: Signs that may also be punctuation between or after words.
PUNCTUATION = "@$!|+*"
#: Costs (negative log likelihoods) of the channel.
COST_LEET, COST_GAP, COST_REPEAT, COST_STAR, COST_DROP, COST_PART = 0.5, 0.2, 0.2, 2.0, 6.0, 2.0

#: The classifier's bounded sample of labelled rows, for each label; smallest hashes first.
SAMPLE_PER_LABEL = 10_000
#: Words the classifier knows, by the strength of their link with the label.
VOCABULARY = 512
#: A word must stand in so many sampled texts.
LEAST_TEXTS = 5
#: Least strength of a word's link: the root of its likelihood ratio, which is about normal where there is no link.
LEAST_STRENGTH = 4.0
ROUNDS, RIDGE = 600, 1e-4

#: Single characters with separators between them.
_SPACED = r"(?<!\w)(?:[a-z0-9@$!|+][ ._\-*]){2,}[a-z0-9@$!|+](?![@$!|*+]*\w)"
NOISY = re.compile(
    rf"{_SPACED}"
    rf"|(?<![\w@$!|*+])(?![@$!|*+]++{_SPACED})(?:"  # whole tokens, of which:
    r"(?=[^\W01345789]*+[01345789@$!|*+])(?=[\d_@$!|*+]*+[^\W\d_])"  # letters and signs, wherever they stand
    r"|(?=\w*?([a-z])\1\1)"  # repetition
    r")[\w@$!|*+]++"
)
#: ASCII punctuation parts words; letters, digits and non-ASCII characters do not.
PARTS = {c: " " for c in range(128) if not chr(c).isalnum()}

_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
_is_letter = np.zeros(256, bool)
_is_letter[97:123] = True
_is_sign = np.zeros(256, bool)
_is_sign[[ord(c) for c in "0134578@$!|*+9"]] = True
_is_word = _is_letter.copy()
_is_word[48:58] = _is_word[128:] = True
_is_neutral = np.zeros(256, bool)
_is_neutral[[ord(c) for c in "26_"]] = True
_code = np.zeros(256, np.int32)
_code[97:123] = np.arange(1, 27)
_code[128:] = 27


def noisy_texts(texts: list[bytes]) -> np.ndarray:
    """Whether a text may hold a word with signs anywhere, a letter three times running, or spaced letters."""
    b = _lower[np.frombuffer(b"\n\n\n".join([b"", *texts, b""]), np.uint8)]
    letter, word, sign = _is_letter[b], _is_word[b], _is_sign[b]
    mark = np.zeros(len(b), bool)
    at = np.flatnonzero(~_is_neutral[b])  # letters and signs of a token meet where nothing else of it stands between
    alpha, leet = (letter | (b > 127))[at], sign[at]
    mark[at[1:]] = (alpha[1:] & leet[:-1]) | (leet[1:] & alpha[:-1])
    mark[2:] |= letter[2:] & (b[2:] == b[1:-1]) & (b[1:-1] == b[:-2])
    single = np.zeros(len(b), bool)
    single[1:-1] = ((word & (b < 128)) | sign)[1:-1] & ~word[:-2] & ~word[2:]
    mark[4:] |= single[4:] & single[2:-2] & single[:-4]
    owner_start = np.cumsum([3, *(len(t) + 3 for t in texts)])
    hits = np.concatenate([[0], np.cumsum(mark)])
    ends = owner_start[1:] - 3
    return hits[ends] > hits[owner_start[:-1]]


def gram_counts(texts: list[bytes]) -> np.ndarray:
    """Counts of character 4-grams inside words, boundaries included."""
    c = _code[_lower[np.frombuffer(b"   ".join([b"", *texts, b""]), np.uint8)]]
    keep = np.ones(len(c), bool)
    keep[3:] = (c[3:] > 0) | (c[2:-1] > 0) | (c[1:-2] > 0)  # three boundaries between words at most
    c = c[keep]
    if len(c) < ORDER:
        return np.zeros(K**ORDER, np.int64)
    # After a boundary, earlier letters are forgotten: words are modelled one by one.
    a, b, d, e = c[:-3], c[1:-2], c[2:-1], c[3:]
    a = np.where((b == 0) | (d == 0), 0, a)
    b = np.where(d == 0, 0, b)
    return np.bincount(((a * K + b) * K + d) * K + e, minlength=K**ORDER)


def char_costs(counts: np.ndarray) -> np.ndarray:
    """(contexts of three, next) negative log probabilities, interpolated down the orders."""
    counts = counts.reshape(K, K, K, K).astype(np.float64)
    p = np.full((1, 1, 1, K), 1 / K)
    for level in (counts.sum(axis=(0, 1, 2), keepdims=True), counts.sum(axis=(0, 1), keepdims=True), counts.sum(axis=0, keepdims=True), counts):
        total, kinds = level.sum(axis=3, keepdims=True), (level > 0).sum(axis=3, keepdims=True)
        p = (level + (kinds + 1) * p) / (total + kinds + 1)  # Witten-Bell
    return -np.log(np.broadcast_to(p, (K, K, K, K))).reshape(K**3, K).astype(np.float32)


@dataclass
class Decoder:
    costs: np.ndarray

    def __post_init__(self) -> None:
        self.table = self.costs.tolist()
        self.known: dict[str, str] = {}
        self.ends: dict[int, list[tuple[list[float], bytes]]] = {}

    def tail(self, after: list[float], drop: float) -> tuple[list[float], bytes]:
        """One star more in front of ``after``, where leaving it out costs ``drop``."""
        rest = np.asarray(after)
        cost = self.costs.astype(float) + COST_STAR + np.tile(rest.reshape(K * K, K), (K, 1))  # context a, b, c and letter d lead to b, c, d
        part = COST_PART + self.costs[:, 0] + rest[0]
        cost[:, 0], cost[:, K - 1] = drop + rest, np.inf
        cost = np.column_stack([cost, part])
        take = cost.argmin(axis=1)
        return cost[np.arange(K**3), take].tolist(), take.astype(np.uint8).tobytes()

    def ending(self, stars: int) -> list[tuple[list[float], bytes]]:
        """For 0 to all of the stars at the end of a token: the cost from each context to the end, the letter to take (0: none, K: a boundary).

        Every context reads a star alike, so a run at the end is solved once for all tokens, not by 27 states more for each star.
        """
        if (out := self.ends.get(stars)) is None:
            out = [(self.costs[:, 0].tolist(), b"")]
            for place in range(stars, 0, -1):
                out.append(self.tail(out[-1][0], COST_REPEAT if stars > 2 and place > 1 else COST_DROP))
            if stars <= 8:
                self.ends[stars] = out
        return out

    @staticmethod
    def spaced(seen: str) -> bool:
        return len(seen) > 4 and all(c in SEPARATORS for c in seen[1::2])

    def readings(self, seen: str) -> list[list[tuple[str, float]]]:
        """The lattice: for each character, (letter, nothing or a space for a word boundary, channel cost)."""
        spaced = self.spaced(seen)
        out, run = [], 0
        for i, c in enumerate(seen):
            run = run + 1 if i and c == seen[i - 1] else 1
            more = i + 1 < len(seen) and seen[i + 1] == c
            if c in SEPARATORS:
                # In a spaced stretch the characters alone tell where words end.
                arcs = [("", COST_GAP), (" ", COST_GAP)]
                if c == "*" and not spaced:
                    arcs = [("", COST_DROP), (" ", COST_PART)] + [(a, COST_STAR) for a in ALPHABET[1:27]]
            elif c in LEET:
                arcs = [(a, COST_LEET) for a in LEET[c]] + [("", COST_DROP)]
                if c in PUNCTUATION:
                    arcs.append((" ", COST_PART))
            else:
                arcs = [(c, 0.0)]
            if run > 2 or run == 2 and (more or run + 1 < 3):
                arcs = arcs + [("", COST_REPEAT * (1 if run > 2 or more else 10))]
            out.append(arcs)
        return out

    def decode(self, seen: str, parts: bool = True) -> str:
        """The likeliest reading, words parted by spaces (unless without ``parts``); states are the last three letters of a word."""
        if parts and (got := self.known.get(seen)) is not None:
            return got
        states: dict[int, tuple[float, tuple | None]] = {0: (0.0, None)}
        arcs_of = self.readings(seen) if parts else [[x for x in arcs if x[0] != " "] for arcs in self.readings(seen)]
        stars = 0 if self.spaced(seen) else len(seen) - len(seen.rstrip("*"))
        for arcs in arcs_of[: len(seen) - stars]:
            after: dict[int, tuple[float, tuple | None]] = {}
            for ctx, (cost, path) in states.items():
                row = self.table[ctx]
                for letter, channel in arcs:
                    if letter == " ":
                        to, new = 0, cost + channel + row[0]
                    elif letter:
                        k = ord(letter) - 96 if "a" <= letter <= "z" else 27
                        to, new = (ctx * K + k) % K**3, cost + channel + row[k]
                    else:
                        to, new = ctx, cost + channel
                    if to not in after or new < after[to][0]:
                        after[to] = (new, (letter, path) if letter else path)
            states = after
        ends = self.ending(stars)
        ctx, path = min(((cost + ends[-1][0][ctx], ctx, path) for ctx, (cost, path) in states.items()), key=lambda x: x[0])[1:]
        letters = []
        while path:
            letters.append(path[0])
            path = path[1]
        letters.reverse()
        for _, take in ends[:0:-1]:
            if (k := take[ctx]) == K:
                letters.append(" ")
                ctx = 0
            elif k:
                letters.append(ALPHABET[k])
                ctx = (ctx * K + k) % K**3
        got = " ".join("".join(letters).split())
        if len(self.known) > 100_000:
            self.known.clear()
        if parts and len(seen) <= 64:
            self.known[seen] = got
        return got

    def restore(self, text: str) -> str:
        """The text in lower case with every noisy stretch replaced by its likeliest reading."""
        return NOISY.sub(lambda m: self.decode(m[0]), text.lower())

    def words(self, text: str, noisy: bool) -> set[str]:
        """Distinct words of the restored text; a text that isn't ``noisy`` is its own reading."""
        return set((self.restore(text) if noisy else text.lower()).translate(PARTS).split())


@dataclass
class Model:
    costs: np.ndarray
    weights: dict[str, float]
    bias: float


def char_model(df: DataFrame, text_col: str = "text") -> np.ndarray:
    """The character model of all texts. A task sends its non-zero counts; at most ``K**ORDER`` sums exist."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(K**ORDER, np.int64)
        for batch in batches:
            for lo, hi in cuts(batch, "text", CHUNK_BYTES):
                total += gram_counts(bytes_list(batch.slice(lo, hi - lo).column("text")))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], ["gram", "n"])

    got = df.select(F.col(f"`{text_col}`").alias("text")).mapInArrow(run, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(K**ORDER, np.int64)
    counts[got.column("gram").to_numpy()] = got.column("n").to_numpy()
    return char_costs(counts)


def label_shares(labels: DataFrame) -> dict[int, float]:
    """Labelled rows for each row that the sample takes, by label: 1 below the cap."""
    keyed = labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return {r["toxic"]: max(1.0, r["n"] / SAMPLE_PER_LABEL) for r in keyed.filter("toxic in (0, 1)").groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}


def sampled_words(df: DataFrame, labels: DataFrame, costs: np.ndarray, id_col: str, text_col: str) -> list[tuple[int, list[str]]]:
    """(label, words that enough sampled texts have) of the bounded sample of labelled rows."""
    keyed = labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).withColumn("h", F.xxhash64("doc_id", F.lit(5)))
    picks = [keyed.filter(F.col("toxic") == y).orderBy("h").limit(SAMPLE_PER_LABEL).select("doc_id", "toxic") for y in (0, 1)]
    sample = F.broadcast(picks[0].unionAll(picks[1]))  # 2 * SAMPLE_PER_LABEL rows of two numbers at most
    docs = rows_of(df, id_col, text_col).join(sample, "doc_id").select("toxic", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(costs)
        for batch in batches:
            for lo, hi in cuts(batch, "text", CHUNK_BYTES):
                part = batch.slice(lo, hi - lo)
                raw = bytes_list(part.column("text"))
                found = [sorted(decoder.words(t.decode(), n)) for t, n in zip(raw, noisy_texts(raw), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("toxic"), pa.array(found, pa.list_(pa.string()))], ["toxic", "words"])

    rows = materialize(docs.mapInArrow(run, "toxic int, words array<string>"), "toxic-words")
    # Words rare in the sample can't be learned; the rest by the strength of their link with the label.
    counted = rows.select("toxic", F.explode("words").alias("word")).groupBy("word").agg(F.sum("toxic").alias("bad"), F.count(F.lit(1)).alias("n")).filter(F.col("n") >= LEAST_TEXTS)
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    good, bad = sizes.get(0, 0), sizes.get(1, 0)

    def part(observed: Column, texts: Column | int, label: int) -> Column:
        expected = texts * F.lit(label / max(1, good + bad))
        return F.when(observed > 0, observed * F.log(observed / expected)).otherwise(0.0)

    n, toxic = F.col("n"), F.col("bad")
    rest = F.lit(good + bad) - n  # texts without the word
    # The root of the likelihood ratio: unlike log odds over their error it keeps growing for words that clean texts never have.
    ratio = part(toxic, n, bad) + part(n - toxic, n, good) + part(F.lit(bad) - toxic, rest, bad) + part(F.lit(good) - n + toxic, rest, good)
    strength = F.sqrt(F.greatest(2 * ratio, F.lit(0.0)))
    top = counted.withColumn("strength", strength).filter(F.col("strength") >= LEAST_STRENGTH).orderBy(F.col("strength").desc(), "word").limit(VOCABULARY).select("word")
    known = sorted(r["word"] for r in top.collect())
    kept = rows.select("toxic", F.array_intersect("words", F.array(*map(F.lit, known)) if known else F.array().cast("array<string>")).alias("words"))
    out = [(r["toxic"], r["words"]) for r in kept.collect()]
    discard(rows)
    return out


def fit(rows: list[tuple[int, list[str]]], shares: dict[int, float] | None = None) -> tuple[dict[str, float], float]:
    """Ridge logistic regression on word presence by accelerated gradient steps.

    A row counts as the ``shares`` rows of its label that it stands for, so the
    prior is that of all labelled rows whatever the sample takes.
    """
    vocabulary = {w: i for i, w in enumerate(sorted({w for _, ws in rows for w in ws}))}
    # Rows with the same words are one, with the shares of either label.
    groups: dict[tuple[int, ...], list[float]] = {}
    for t, ws in rows:
        groups.setdefault(tuple(sorted({vocabulary[w] for w in ws})), [0.0, 0.0])[t] += (shares or {}).get(t, 1.0)
    total = np.array([groups[k] for k in sorted(groups)]).reshape(-1, 2)
    if not total[:, 0].any() or not total[:, 1].any():
        return {}, (0.0 if not rows else 4.0 if total[:, 1].any() else -4.0)
    total /= total.sum()
    share, bad = total.sum(axis=1), total[:, 1]
    x = np.zeros((len(groups), len(vocabulary) + 1))
    for i, ws in enumerate(sorted(groups)):
        x[i, list(ws)] = 1
    x[:, -1] = 1
    w, v, ridge = np.zeros(x.shape[1]), np.zeros(x.shape[1]), np.full(x.shape[1], RIDGE)
    ridge[-1] = 0
    step = 4 / np.linalg.norm(x.T @ (x * share[:, None]), 2)
    for k in range(ROUNDS):
        p = 1 / (1 + np.exp(-np.clip(x @ v, -30, 30)))
        new = v - step * (x.T @ (p * share - bad) + ridge * v)
        v, w = new + k / (k + 3) * (new - w), new
    return {word: float(w[i]) for word, i in vocabulary.items()}, float(w[-1])


def train(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Character costs from all texts, word weights from labelled rows (doc_id, toxic), null labels left out."""
    costs = char_model(df, text_col)
    labels = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter("doc_id is not null and toxic is not null")
    weights, bias = fit(sampled_words(df, labels, costs, id_col, text_col), label_shares(labels))
    return Model(costs, weights, bias)


def score(df: DataFrame, model: Model, text_col: str = "text", restored: bool = False, score_col: str = "toxic_score") -> DataFrame:
    """``df`` with ``score_col`` (and ``restored_text``), in place of columns that have these names already.

    Null and empty texts get the model's base score, repeated rows the same; an empty table stays empty.
    """
    extra = [(score_col, "double", pa.float64())] + [("restored_text", "string", pa.string())] * restored
    df = df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in {n.lower() for n, _, _ in extra}])
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema] + [f"{n} {t}" for n, t, _ in extra])
    vocabulary = set(model.weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(model.costs)
        for batch in batches:
            for lo, hi in cuts(batch, text_col, CHUNK_BYTES):
                part = batch.slice(lo, hi - lo)
                raw = bytes_list(part.column(text_col))
                out, plain = [], []
                for t, noisy in zip(raw, noisy_texts(raw), strict=True):
                    text = t.decode()
                    z = model.bias + math.fsum(model.weights[w] for w in vocabulary & decoder.words(text, noisy))
                    out.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
                    if restored:
                        plain.append(decoder.restore(text))
                cols = [pa.array(out, pa.float64())] + [pa.array(plain, pa.string())] * restored
                yield pa.RecordBatch.from_arrays([*part.columns, *cols], [*part.schema.names, *(n for n, _, _ in extra)])

    return df.mapInArrow(run, schema)


def learn_from(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, held_out: int = 0) -> Model:
    return train(df, labels.filter(crc_mod("doc_id", folds) != held_out), id_col, text_col)


def toxicity(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, held_out: int = 0) -> DataFrame:
    """doc_id, held_out, score, predicted of each row; learns outside the held-out fold.

    Nulls count as empty texts, repeated rows are scored each, tables without
    usable labels give the score 0.5 (none) or a constant (one label only).
    """
    model = learn_from(df, labels, id_col, text_col, folds, held_out)
    docs = rows_of(df, id_col, text_col, (crc_mod(id_col, folds) == held_out).alias("held_out"))
    s = F.col("toxic_score")
    return score(docs, model).select("doc_id", "held_out", s.alias("score"), (s >= 0.5).cast("int").alias("predicted"))
