"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +-1. A trigram's vector binds its letters:
the product of the first letter's vector rotated twice, the second's rotated
once and the third's. A text bundles (sums) the vectors of its trigrams, a
language those of its training texts; a text belongs to the prototype of the
highest cosine. Runs of other characters count as one space.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import crc_mod, rows_of

DIMENSION = 1024
#: Characters handled at once; a longer text is handled alone.
BATCH_CHARS = 1 << 20
UNKNOWN = "und"

_letters: np.ndarray | None = None
_vectors: dict[tuple[int, int], np.ndarray] = {}
_grams: dict[tuple[int, int, int], np.ndarray] = {}


def letter_table() -> np.ndarray:
    """Whether a code point is a letter."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letters


def letter_vector(point: int, dimension: int) -> np.ndarray:
    key = (point, dimension)
    if key not in _vectors:
        _vectors[key] = np.random.default_rng([point, dimension]).integers(0, 2, dimension, dtype=np.int8) * 2 - 1
    return _vectors[key]


def gram_vector(gram: tuple[int, int, int], dimension: int) -> np.ndarray:
    """The bound vector, as float32; a bounded number of them is remembered."""
    if (v := _grams.get(gram)) is None or len(v) != dimension:
        a, b, c = (letter_vector(p, dimension) for p in gram)
        v = (np.roll(a, 2) * np.roll(b, 1) * c).astype(np.float32)
        if len(_grams) > 20_000:
            _grams.clear()
        _grams[gram] = v
    return v


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text index, gram index, count) by ascending text, and (grams, 3) of code points in that index."""
    points = np.frombuffer("".join(t.lower().replace("\0", " ") + "\0" for t in texts).encode("utf-32-le", "replace"), np.uint32)
    ends = points == 0
    points = np.where(letter_table()[np.minimum(points, 0x10FFFF)], points, 32)
    owner = np.cumsum(ends) - ends
    # One space for each run of other characters; every text ends with one.
    keep = np.ones(len(points), bool)
    keep[1:] = (points[1:] != 32) | (points[:-1] != 32) | ends[:-1]  # runs don't reach across texts
    keep |= ends
    points, owner = points[keep], owner[keep]
    if len(points) < 3:
        return np.zeros((0, 3), np.int64), np.zeros((0, 3), np.int64)
    present, dense = np.unique(points, return_inverse=True)
    k = len(present)
    code = (dense[:-2].astype(np.int64) * k + dense[1:-1]) * k + dense[2:]
    ok = (owner[:-2] == owner[2:]) & (points[1:-1] != 32)
    code, owner = code[ok], owner[:-2][ok]
    grams, gram = np.unique(code, return_inverse=True) if k > 128 else sparse(code, k**3)
    counts = np.bincount(owner.astype(np.int64) * len(grams) + gram) if len(texts) * len(grams) < 1 << 25 else None
    if counts is None:
        pairs, n = np.unique(owner.astype(np.int64) * len(grams) + gram, return_counts=True)
    else:
        pairs = np.flatnonzero(counts)
        n = counts[pairs]
    triples = np.stack([pairs // max(1, len(grams)), pairs % max(1, len(grams)), n], axis=1)
    return triples, present[np.stack([grams // (k * k), grams // k % k, grams % k], axis=1)]


def sparse(code: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """``np.unique`` with inverse, for codes below a small size."""
    seen = np.bincount(code, minlength=size) > 0
    return np.flatnonzero(seen), (np.cumsum(seen) - 1)[code]


def bundles(texts: list[str], dimension: int) -> Iterator[tuple[int, np.ndarray]]:
    """(index of the first text, bundled vectors of it and its successors), a few hundred texts at once."""
    for lo in range(0, len(texts), 256):
        part = texts[lo : lo + 256]
        triples, grams = trigrams(part)
        out = np.zeros((len(part), dimension), np.float32)
        for g in range(0, len(grams), 4096):  # bounds the dense count matrix
            vectors = np.stack([gram_vector(tuple(x), dimension) for x in grams[g : g + 4096].tolist()])
            own = triples[(triples[:, 1] >= g) & (triples[:, 1] < g + 4096)]
            counts = np.zeros((len(part), len(vectors)), np.float32)
            counts[own[:, 0], own[:, 1] - g] = own[:, 2]
            out += counts @ vectors
        yield lo, out


def batches_of(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    texts = [t or "" for t in batch.column("text").to_pylist()]
    lo = total = 0
    for i, t in enumerate(texts):
        if i > lo and (total + len(t) > BATCH_CHARS):
            yield batch.slice(lo, i - lo), texts[lo:i]
            lo, total = i, 0
        total += len(t)
    if lo < len(texts):
        yield batch.slice(lo), texts[lo:]


def train(df: DataFrame, text_col: str = "text", lang_col: str = "lang", dimension: int = DIMENSION) -> dict[str, list[float]]:
    """Language prototypes from all rows of ``df`` with a language.

    A task adds up trigram counts by language and binds each trigram once; only
    one vector per task and language is shuffled, and one per language reaches
    the driver. Rows with a null language or text teach nothing.
    """
    rows = df.select(F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang")).filter("lang is not null and text is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for part, texts in batches_of(batch):
                langs = part.column("lang").to_pylist()
                triples, grams = trigrams(texts)
                names = sorted(set(langs))
                of = np.array([names.index(x) for x in langs])
                for i, name in enumerate(names):
                    own = triples[of[triples[:, 0]] == i]
                    counts = np.bincount(own[:, 1], weights=own[:, 2], minlength=len(grams))
                    total = sums.setdefault(name, np.zeros(dimension))
                    for g in np.flatnonzero(counts):
                        total += counts[g] * gram_vector(tuple(grams[g].tolist()), dimension)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))], ["lang", "v"])

    parts = rows.mapInArrow(run, "lang string, v array<double>")
    total = parts.select("lang", F.posexplode("v").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x"))
    got = total.groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("v")).collect()
    return {r["lang"]: list(r["v"]) for r in sorted(got, key=lambda r: r["lang"])}


def predict(df: DataFrame, prototypes: dict[str, list[float]], id_col: str = "doc_id", text_col: str = "text", *extra) -> DataFrame:
    """doc_id, extra columns, lang_pred, score of each row.

    ``und`` with score 0 where a text is null or has no letter, or where no
    language was learned. The score is the cosine, 0 where negative; ties go to
    the first language by name. Row by row: nulls and repeated rows pass.
    """
    docs = rows_of(df, id_col, text_col, *extra)
    names = sorted(prototypes)
    matrix = np.array([prototypes[x] for x in names], np.float64).reshape(len(names), len(prototypes[names[0]]) if names else 1)
    matrix = (matrix / np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-12)).astype(np.float32)
    dimension = matrix.shape[1] or 1
    kept = [c for c in docs.columns if c != "text"]
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept) + ", lang_pred string, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in batches_of(batch):
                best, score = np.zeros(len(texts), int), np.zeros(len(texts))
                if names:
                    for lo, v in bundles(texts, dimension):
                        norm = np.linalg.norm(v, axis=1)
                        cosine = (v @ matrix.T) / np.maximum(norm, 1e-12)[:, None]
                        best[lo : lo + len(v)] = cosine.argmax(axis=1)
                        score[lo : lo + len(v)] = np.where(norm > 0, cosine.max(axis=1), -1)
                table = letter_table()
                lettered = [bool(names) and (s >= 0 or any(table[ord(c)] for c in t)) for s, t in zip(score, texts, strict=True)]
                lang = [names[i] if ok else UNKNOWN for i, ok in zip(best, lettered, strict=True)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), pa.array(lang, pa.string()), pa.array(np.clip(np.where(lettered, score, 0), 0, 1), pa.float64())], [*kept, "lang_pred", "score"])

    return docs.mapInArrow(run, schema)


def identify(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 4, held_out: int = 2, dimension: int = DIMENSION) -> DataFrame:
    """doc_id, held_out, lang_pred, score of each row; learns from the rows outside the held-out fold.

    Null, empty and letterless texts are ``und`` with score 0; so is every text
    if no row teaches a language. Ties of the cosine go to the first language by
    name, repeated rows are predicted alike (and each teaches), null ids count
    as the empty string, an empty table stays empty. Other columns aren't read.
    """
    fold = crc_mod(id_col, folds)
    prototypes = train(df.filter(fold != held_out), text_col, lang_col, dimension)
    return predict(df, prototypes, id_col, text_col, (fold == held_out).alias("held_out"))
