"""Secret scans: fixed patterns, and a linear-chain conditional random field over words.

The field tags every word as begin, inside or outside of a secret from its
shape, the words before it and features of its file. It learns from a bounded
sample of the texts: the spans of the fixed patterns in them, and secrets of
shapes that the patterns miss, planted among their words together with
look-alikes that are none. It is decoded by Viterbi; its spans are added to
those of the patterns where they don't overlap them.
"""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import planted
from millrace.llm.common import discard, fresh, map_texts, materialize, rows_of

KINDS = ("assign", "access", "hex", "crf")
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{24,}")
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
#: Some part of every ``ASSIGN`` match, lower case.
ASSIGN_HINTS = (b"passw", b"secret", b"token", b"api")
#: The union of the patterns for Spark's own engine, only to find texts to learn from.
ANY_PATTERN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]|AKIA[A-Z0-9]{16}|[0-9a-f]{24}"""

#: Texts to learn from: with and without a match, smallest hashes first.
SAMPLE_WITH, SAMPLE_WITHOUT = 400, 300
#: Words kept on either side of a learned secret; secrets learned from one text, at hash-random ones of all of it.
CONTEXT, MARKS = 20, 4
#: Stretches of so many words, at hash-random places, from each text without a match, as it is; times that it is
#: planted, and look-alikes for each planted secret.
STRETCH, STRETCHES, PLANTED, ALIKES = 60, 3, 2, 3
EPOCHS, RATE, DECAY = 60, 0.5, 1e-4
#: Shortest span of the field, in bytes.
MIN_BYTES = 6
#: Transition weights stay within this; the tighter, the more words are outside for certain.
MOVE_LIMIT = 1.0

KEYWORDS = ("password", "passwd", "pwd", "secret", "token", "apikey", "key", "auth", "bearer", "credential")
O, B, I = range(3)
_EDGE = b"\"'`,;:!?.#*$%&|<>()[]{}"

_rng = np.random.default_rng(9)
_letter = _rng.integers(1, 1 << 63, 26, dtype=np.uint64)
#: A word's letters hash to the sum of their numbers, so that quotes and case do not matter.
LETTER_SUM = np.zeros(256, np.uint64)
LETTER_SUM[97:123] = LETTER_SUM[65:91] = _letter
KEYWORD_SUMS = np.array(sorted(int(LETTER_SUM[np.frombuffer(k.encode(), np.uint8)].sum()) for k in KEYWORDS), np.uint64)
#: Counts of lower case, upper case and digits, in fields of 21 bits.
CLASS = np.zeros(256, np.int64)
CLASS[97:123], CLASS[65:91], CLASS[48:58] = 1, 1 << 21, 1 << 42
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
DIGIT = CLASS == 1 << 42
#: Sizes of the feature groups, in the order of ``features``.
GROUPS = (10, 5, 16, 8, 11, 13, 13, 5, 32)
OFFSETS = np.concatenate([[0], np.cumsum(GROUPS)])


def base_spans(text: bytes) -> list[tuple[int, int, int]]:
    """(start, end, kind) in bytes, by start, then kind."""
    out = []
    low = text.lower()
    if any(h in low for h in ASSIGN_HINTS):
        out += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if b"AKIA" in text:
        out += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], s[2]))


def words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(buffer, start of each text, start, end and text of each word)."""
    buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    at = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    space = SPACE[buf]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if len(space) and not space[0]:
        edge = np.concatenate([[0], edge])
    start, end = edge[0::2], edge[1::2]
    return buf, at, start, end, np.searchsorted(at, start, "right") - 1


def features(buf: np.ndarray, at: np.ndarray, start: np.ndarray, end: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """(words, groups) of indices into the weights."""
    n = len(start)
    out = np.zeros((n, len(GROUPS)), np.int32)
    if not n:
        return out
    length = end - start
    counts = np.add.reduceat(CLASS[buf], start)
    lower, upper, digit = counts & 0x1FFFFF, counts >> 21 & 0x1FFFFF, counts >> 42
    other = np.maximum(0, length - lower - upper - digit)
    turn = np.zeros(len(buf), np.int32)
    turn[1:] = DIGIT[buf[1:]] != DIGIT[buf[:-1]]
    turns = np.add.reduceat(turn, start)
    sums = np.add.reduceat(LETTER_SUM[buf], start)
    k = np.minimum(np.searchsorted(KEYWORD_SUMS, sums), len(KEYWORD_SUMS) - 1)
    keyword = np.where(KEYWORD_SUMS[k] == sums, k + 1, 0)
    sign = (length <= 2) & ((buf[start] == 61) | (buf[start] == 58))
    joined = np.add.reduceat(((buf == 61) | (buf == 58)).astype(np.int32), start) > 0
    context = np.where(keyword > 0, keyword, np.where(sign, 11, np.where(joined, 12, 0)))
    same1, same2 = np.zeros(n, bool), np.zeros(n, bool)
    same1[1:], same2[2:] = owner[1:] == owner[:-1], owner[2:] == owner[:-2]
    size = at[owner + 1] - at[owner]
    symbols = np.bincount(owner, weights=other, minlength=len(at) - 1) / np.maximum(1, np.diff(at))
    out[:, 0] = np.minimum(9, np.log2(length).astype(int))
    out[:, 1] = np.where(digit == 0, 0, np.where(digit == length, 4, 1 + (digit * 5 > length) + (digit * 5 > 3 * length)))
    out[:, 2] = (lower > 0) + 2 * (upper > 0) + 4 * (digit > 0) + 8 * (other > 0)
    out[:, 3] = np.minimum(7, turns)
    out[:, 4] = keyword
    out[1:, 5] = np.where(same1[1:], context[:-1], 0)
    out[2:, 6] = np.where(same2[2:], context[:-2], 0)
    out[:, 7] = np.minimum(4, np.log2(np.maximum(1, size / 512)).astype(int))
    out[:, 8] = np.minimum(7, (symbols[owner] * 20).astype(int)) * 4 + np.minimum(3, other)
    return out + OFFSETS[:-1].astype(np.int32)


@dataclass
class Field:
    weights: np.ndarray  # (features, 3)
    moves: np.ndarray  # (3, 3) from, to

    def emissions(self, feats: np.ndarray) -> np.ndarray:
        out = np.zeros((len(feats), 3))
        for g in range(feats.shape[1]):
            out += self.weights[feats[:, g]]
        return out

    def tags(self, emit: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Viterbi states. A word is outside in every best path where that beats the
        others by more than all that transitions on both sides can give; such words
        cut the chain, and the rest is decoded run by run."""
        margin = 2 * (self.moves.max() - self.moves.min())
        tags = np.zeros(len(emit), np.int8)
        open_words = np.flatnonzero(emit[:, O] - emit[:, 1:].max(axis=1) <= margin)
        if not len(open_words):
            return tags
        cut = np.flatnonzero((np.diff(open_words) > 1) | (owner[open_words[1:]] != owner[open_words[:-1]])) + 1
        for run in np.split(open_words, cut):
            lo, hi = run[0], run[-1]
            before = lo > 0 and owner[lo - 1] == owner[lo]
            after = hi + 1 < len(owner) and owner[hi + 1] == owner[hi]
            score = emit[lo] + (self.moves[O] if before else 0.0)
            back = []
            for i in range(lo + 1, hi + 1):
                step = score[:, None] + self.moves
                back.append(step.argmax(axis=0))
                score = step.max(axis=0) + emit[i]
            s = int((score + (self.moves[:, O] if after else 0)).argmax())
            for i in range(hi, lo - 1, -1):
                tags[i] = s
                s = int(back[i - lo - 1][s]) if i > lo else s
        return tags


def hash_places(text: bytes, n: int, k: int, salt: int) -> list[int]:
    """At most ``k`` places out of ``n``, all of them if there are no more."""
    if n <= k:
        return list(range(n))
    return sorted({zlib.crc32(text, salt + j) % n for j in range(k)})


Sequence = tuple[np.ndarray, np.ndarray]


def tagged(text: bytes, spans: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """(features, tags, first and last word and one of each span) of a text with secrets at ``spans``."""
    buf, at, start, end, owner = words([text])
    feats, tags, marks = features(buf, at, start, end, owner), np.zeros(len(start), np.int64), []
    for lo, hi in spans:
        i, j = int(np.searchsorted(end, lo, "right")), int(np.searchsorted(start, hi))
        if j > i:
            tags[i], tags[i + 1 : j] = B, I
            marks.append((i, j))
    return feats, tags, marks


def around(feats: np.ndarray, tags: np.ndarray, i: int, j: int) -> Sequence:
    lo, hi = max(0, i - CONTEXT), min(len(tags), j + CONTEXT)
    return feats[lo:hi], tags[lo:hi]


def training_sequences(text: bytes) -> list[Sequence]:
    """What a text teaches: the words around its secrets, or, without one, stretches of it as they are and planted ones."""
    base = [(hi - len(ASSIGN.match(text, lo)[2]) if kind == 0 else lo, hi) for lo, hi, kind in base_spans(text)]
    feats, tags, marks = tagged(text, base)
    if marks:
        return [around(feats, tags, *marks[k]) for k in hash_places(text, len(marks), MARKS, 1)]
    n = len(tags)
    out = [(feats[k : k + STRETCH], tags[k : k + STRETCH]) for k in hash_places(text, max(1, n - STRETCH + 1), STRETCHES, 1)] if n else []
    for lo in hash_places(text, n + 1, PLANTED, 2):
        r, cuts = random.Random(zlib.crc32(text, lo + 3)), [m.start() for m in WORD.finditer(text)]
        place = cuts[lo] if lo < n else len(text)
        new, secret = planted.with_secret(r)
        after: list[str] = []
        for _ in range(ALIKES):
            after += planted.alike(r)
        before, own = (" ".join([*x, ""]).encode() for x in (planted.alike(r) + new[: len(new) - secret], new[len(new) - secret :]))
        at = place + len(before) + 1
        made = text[:place] + b" " + before + own + " ".join([*after, ""]).encode() + text[place:]
        feats, tags, marks = tagged(made, [(at, at + len(own) - 1)])
        out += [around(feats, tags, i, j) for i, j in marks]
    return out


def fit(sequences: list[tuple[np.ndarray, np.ndarray]]) -> Field:
    """Maximum likelihood with AdaGrad; forward and backward sums over all sequences at once."""
    field = Field(np.zeros((int(OFFSETS[-1]), 3)), np.zeros((3, 3)))
    sequences = [s for s in sequences if len(s[1])]
    if not any(t.any() for _, t in sequences):
        field.weights[:, O] = 5.0  # nothing to learn from: all outside
        return field
    n, longest = len(sequences), max(len(t) for _, t in sequences)
    feats = np.zeros((n, longest, len(GROUPS)), np.int32)
    tags = np.zeros((n, longest), np.int64)
    size = np.array([len(t) for _, t in sequences])
    for i, (f, t) in enumerate(sequences):
        feats[i, : len(t)], tags[i, : len(t)] = f, t
    live = np.arange(longest)[None, :] < size[:, None]
    truth = np.eye(3)[tags] * live[..., None]
    seen_moves = np.einsum("nta,ntb->ab", truth[:, :-1], truth[:, 1:])
    sums = [np.zeros_like(field.weights), np.zeros((3, 3))]
    for _ in range(EPOCHS):
        emit = field.weights[feats].sum(axis=2)
        forward, backward = np.zeros_like(emit), np.zeros_like(emit)
        forward[:, 0] = emit[:, 0]
        for t in range(1, longest):
            forward[:, t] = np.logaddexp.reduce(forward[:, t - 1][:, :, None] + field.moves, axis=1) + emit[:, t]
        for t in range(longest - 2, -1, -1):
            inner = np.logaddexp.reduce(field.moves[None] + (emit[:, t + 1] + backward[:, t + 1])[:, None, :], axis=2)
            backward[:, t] = np.where(live[:, t + 1][:, None], inner, 0)
        total = np.logaddexp.reduce(forward[np.arange(n), size - 1], axis=1)
        belief = np.exp(forward + backward - total[:, None, None]) * live[..., None]
        pair = forward[:, :-1, :, None] + field.moves + (emit[:, 1:] + backward[:, 1:])[:, :, None, :] - total[:, None, None, None]
        moved = (np.exp(np.minimum(pair, 0)) * live[:, 1:, None, None]).sum(axis=(0, 1))
        grad = np.zeros_like(field.weights)
        error = truth - belief
        for g in range(len(GROUPS)):
            for k in range(3):
                grad[:, k] += np.bincount(feats[:, :, g].reshape(-1), weights=error[:, :, k].reshape(-1), minlength=len(grad))
        for x, g, s in ((field.weights, grad / n - DECAY * field.weights, sums[0]), (field.moves, (seen_moves - moved) / n - DECAY * field.moves, sums[1])):
            s += g * g
            x += RATE * g / np.sqrt(s + 1e-8)
        np.clip(field.moves, -MOVE_LIMIT, MOVE_LIMIT, out=field.moves)
    return field


def sample_sequences(df: DataFrame, text_col: str, with_match: int = SAMPLE_WITH, without: int = SAMPLE_WITHOUT) -> list[Sequence]:
    """What at most ``with_match`` + ``without`` distinct texts teach, those of the smallest hashes.

    Hashes choose first. Features and tags are computed where the texts are, so
    what comes to the driver is bounded whatever the lengths of texts: per text
    at most MARKS or STRETCHES + PLANTED sequences.
    """
    rows = df.select(F.col(f"`{text_col}`").alias("text")).filter("text is not null").withColumn("h", F.xxhash64("text", F.lit(9)))
    seen = materialize(rows.groupBy("h").agg(F.max(F.col("text").rlike(ANY_PATTERN)).alias("hit")), "secret-hashes")
    chosen = [r.h for want, n in (("hit", with_match), ("not hit", without)) for r in seen.filter(want).orderBy("h").limit(n).select("h").collect()]
    discard(seen)
    if not chosen:
        return []

    def teach(texts: list[bytes], cols: dict[str, pa.Array]) -> dict[str, object]:
        got = [[(f.astype(np.int32).tobytes(), t.astype(np.int8).tobytes()) for f, t in training_sequences(x)] for x in texts]
        return {"h": cols["h"], "learned": pa.array([[{"f": f, "t": t} for f, t in g] for g in got], pa.list_(pa.struct([("f", pa.binary()), ("t", pa.binary())])))}

    got = map_texts(rows.filter(F.col("h").isin(chosen)), "h long, learned array<struct<f:binary,t:binary>>", teach)
    # Copies teach the same.
    found = got.groupBy("h").agg(F.min("learned").alias("learned")).orderBy("h").collect()
    return [(np.frombuffer(x.f, np.int32).reshape(-1, len(GROUPS)), np.frombuffer(x.t, np.int8).astype(np.int64)) for r in found for x in r.learned]


def train(df: DataFrame, text_col: str = "text") -> Field:
    """The field that ``df``'s texts teach; without texts (an empty table, nulls only) one that tags nothing."""
    return fit(sample_sequences(df, text_col))


def all_spans(texts: list[bytes], field: Field) -> tuple[list[list[tuple[int, int, int]]], list[list[tuple[int, int, int]]]]:
    """Base spans and those of the field, in bytes of each text."""
    base = [base_spans(t) for t in texts]
    buf, at, start, end, owner = words(texts)
    tags = field.tags(field.emissions(features(buf, at, start, end, owner)), owner) if len(start) else np.zeros(0)
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    hits = np.flatnonzero(tags)
    k = 0
    while k < len(hits):
        i = j = hits[k]
        k += 1
        while k < len(hits) and hits[k] == j + 1 and tags[hits[k]] == I and owner[hits[k]] == owner[i]:
            j = hits[k]
            k += 1
        own = owner[i]
        text, lo, hi = texts[own], int(start[i] - at[own]), int(end[j] - at[own])
        piece = text[lo:hi]
        lo += len(piece) - len(piece.lstrip(_EDGE))
        hi -= len(piece) - len(piece.rstrip(_EDGE))
        if hi - lo >= MIN_BYTES and not any(s < hi and lo < e for s, e, _ in base[own]):
            found[own].append((lo, hi, 3))
    return base, found


def characters(text: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Byte offsets to code points."""
    if text.isascii() or not spans:
        return spans
    first = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
    count = lambda i: int(first[i - 1]) if i else 0
    return [(count(s), count(e), k) for s, e, k in spans]


def line(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in sorted(spans, key=lambda x: (x[0], x[2])))


def scan_secrets(df: DataFrame, field: Field | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of each row.

    Null text is empty and has no span. Rows stand alone: repeated rows and
    null ids pass. A span is that of the whole match, in code points, end
    exclusive. Without texts to learn from, the field tags nothing.
    """
    field = field or train(df, text_col)
    docs = rows_of(df, id_col, text_col)
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"

    def run(texts: list[bytes], cols: dict[str, pa.Array]) -> dict[str, object]:
        base, more = all_spans(texts, field)
        base = [characters(t, s) for t, s in zip(texts, base, strict=True)]
        more = [characters(t, s) for t, s in zip(texts, more, strict=True)]
        n = [[sum(s[2] == k for s in b) for b in base] for k in range(3)]
        return {"doc_id": cols["doc_id"], "n_assign": n[0], "n_access": n[1], "n_hex": n[2], "base_sha256": [hashlib.sha256(line(b).encode()).hexdigest() for b in base], "spans": [line(b + m) for b, m in zip(base, more, strict=True)]}

    return map_texts(docs, schema, run)


def redact(df: DataFrame, field: Field | None = None, text_col: str = "text", mark: str = "[secret]") -> DataFrame:
    """``df`` with every span of its texts replaced by ``mark``; overlapping spans are replaced as one.

    Rows without a span, null and empty texts included, are left as they are,
    repeated rows alike. Further columns may have any names.
    """
    field = field or train(df, text_col)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    token, (gone,) = mark.encode(), fresh(df, "gone")

    def clean(text: bytes, spans: list[tuple[int, int, int]]) -> bytes:
        out, at = [], 0
        for s, e, _ in sorted(spans):
            if s >= at:
                out += [text[at:s], token]
            at = max(at, e)
        return b"".join([*out, text[at:]])

    def run(texts: list[bytes], cols: dict[str, pa.Array]) -> dict[str, object]:
        base, more = all_spans(texts, field)
        nulls = cols[gone].to_pylist()
        done = [None if null else clean(t, b + m).decode() for t, b, m, null in zip(texts, base, more, nulls, strict=True)]
        return {**cols, text_col: done}

    return map_texts(df.withColumn(gone, F.col(f"`{text_col}`").isNull()), schema, run, text_col)
