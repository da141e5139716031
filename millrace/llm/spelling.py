"""Spelling variants: every word's whole neighbourhood, hash-joined to the vocabulary.

A word's neighbourhood is all distinct strings that one deleted, replaced or
inserted code point of the observed alphabet makes of it. A neighbour that
is a word is near by construction; no distance is computed. Most of the
neighbourhood is no word: before candidates are written out and shuffled,
a Bloom filter of the vocabulary, of one size whatever the vocabulary's, drops
them. It never drops a word. A word is a candidate of at most its own
neighbourhood, so no key of the join is hot whatever the texts repeat.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import discard, materialize, rows_of
from millrace.llm.hashing import BASE, INVERSE, U, mix, powers

RUN = r"[A-Za-z\x{C0}-\x{FF}]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A run loses a code point where its hash is a multiple of this.
PLANTED = 97
LEAST_LENGTH, LEAST_COUNT, FORM_FACTOR = 5, 3, 2
#: Bits of the filter (32 MB, whatever the vocabulary) and probes of each string: of strings that are no word, 1e-10 pass at a
#: million words, 6e-5 at ten million.
BITS, PROBES = 1 << 28, 6
#: Bits of one row of Spark's bitmaps.
BITMAP = 1 << 15
#: Candidates whose hashes are held at once.
HELD = 1 << 17
#: Words whose neighbourhoods, some thousand times as many strings, one task makes.
TASK_WORDS = 1 << 13
#: A random number for every code point of the runs.
CODES = np.random.default_rng(12).integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)


def words(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, n: the distinct words of all texts; a null id is an empty one in the hash, a null text has no runs."""
    runs = rows_of(df, id_col, text_col).select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), F.translate("text", UPPER, LOWER).alias("text"))
    runs = runs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run"))
    h = F.crc32(F.concat("doc_id", F.lit(":"), "run").cast("binary"))
    at = (h % F.char_length("run")).cast("int")
    cut = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    made = runs.select(F.when(h % PLANTED == 0, cut).otherwise(F.col("run")).alias("word"))
    return made.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") >= LEAST_COUNT) & (F.char_length("word") >= LEAST_LENGTH))


def probe(h: np.ndarray, k: int) -> np.ndarray:
    """The ``k``-th bit of strings by their hashes; the first one is plain, as all candidates ask for it."""
    return (h if k == 0 else mix(h + U(k) * (mix(h) | U(1)))) >> U(64 - BITS.bit_length() + 1)


class Flat:
    """The code points of many words in a row, and the sums that hash any edit of any of them."""

    def __init__(self, found: list[str]):
        code = [np.frombuffer(w.encode("latin-1"), np.uint8) for w in found]
        self.size = np.array([len(c) for c in code], np.int64)
        self.code = np.concatenate([np.zeros(0, np.uint8), *code])
        self.first = np.concatenate([[0], np.cumsum(self.size)])
        self.owner = np.repeat(np.arange(len(found)), self.size)
        self.place = np.arange(len(self.code)) - self.first[self.owner]
        self.power = powers(int(self.size.max(initial=0)) + 1)[0]
        sums = np.concatenate([[U(0)], np.cumsum(CODES[self.code] * self.power[self.place], dtype=U)])
        self.before = sums[:-1] - sums[self.first[self.owner]]
        self.whole = sums[self.first[1:]] - sums[self.first[:-1]]


def passing(h: np.ndarray, wanted: np.ndarray | None) -> np.ndarray:
    """Places of the hashes that the filter's bytes let through, all of them without a filter."""
    if wanted is None:
        return np.arange(len(h))
    at = None
    for k in range(PROBES):
        bit = probe(h if at is None else h[at], k).astype(np.uint32)
        hit = np.flatnonzero(wanted[bit >> np.uint32(3)] >> (bit & np.uint32(7)).astype(np.uint8) & np.uint8(1))
        at = hit if at is None else at[hit]
    return at


def neighbourhood(found: list[str], alphabet: str, wanted: np.ndarray | None = None) -> Iterator[tuple[int, str]]:
    """(number of a word, a string one edit away), every distinct one once; with a filter only those that it lets through.

    Of equal neighbouring code points the first one is deleted, and nothing is
    inserted after an equal code point: the other places give the same strings.
    """
    flat, letters = Flat(found), np.frombuffer(alphabet.encode("latin-1"), np.uint8)
    last = np.concatenate([np.zeros(1, np.uint8), flat.code[:-1]]) if len(flat.code) else flat.code
    last = np.where(flat.place == 0, 0, last)  # the code point before; 0 is no letter
    rows = max(1, HELD // max(1, len(letters)))
    for lo in range(0, len(flat.code), rows):
        s = slice(lo, lo + rows)
        own, place, code, p, q = flat.owner[s], flat.place[s], flat.code[s], flat.before[s], last[s]
        power, after = flat.power[place], flat.whole[own] - p
        rest = after - CODES[code] * power  # of what follows the code point
        end = np.flatnonzero(place == flat.size[own] - 1)
        added = CODES[letters][None, :] * power[:, None]
        beyond = CODES[letters][None, :] * (power[end] * U(BASE))[:, None]
        # (rows, hashes by row and letter, which of them are strings not made elsewhere, code points before and skipped)
        edits = (
            (np.arange(len(own)), (p + rest * U(INVERSE))[:, None], (code != q)[:, None], 0, 1),
            (np.arange(len(own)), (p + rest)[:, None] + added, letters[None, :] != code[:, None], 0, 1),
            (np.arange(len(own)), (p + after * U(BASE))[:, None] + added, letters[None, :] != q[:, None], 0, 0),
            (end, flat.whole[own[end]][:, None] + beyond, letters[None, :] != code[end][:, None], 1, 0),
        )
        for kind, (row, h, new, beside, skipped) in enumerate(edits):
            at = passing(h.reshape(-1), wanted)
            at, wide = at[new.reshape(-1)[at]], h.shape[1]
            for r, k in zip(row[at // max(1, wide)].tolist(), (at % max(1, wide)).tolist(), strict=True):
                w, i = found[own[r]], int(place[r]) + beside
                yield int(own[r]), w[:i] + (alphabet[k] if kind else "") + w[i + skipped :]


def vocabulary_filter(vocabulary: DataFrame) -> np.ndarray:
    """The filter's bytes: bits are set by task, merged by Spark's bitmaps and come as 32 MB at most."""

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = Flat(batch.column(0).to_pylist()).whole
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([probe(h, k) for k in range(PROBES)]).astype(np.int64) + 1)], ["bit"])

    bit_rows = vocabulary.select("word").mapInArrow(bits, "bit long").select("bit", F.bitmap_bucket_number("bit").alias("bucket"))
    set_bits = bit_rows.repartition("bucket").groupBy("bucket")  # bits are few beside bitmaps: they are shuffled, not partial bitmaps
    out = np.zeros((BITS // BITMAP, BITMAP // 8), np.uint8)
    for r in set_bits.agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")).collect():
        out[r.bucket - 1] = np.frombuffer(r.bits, np.uint8)
    return out.reshape(-1)


def near_words(vocabulary: DataFrame) -> DataFrame:
    """word, near: all pairs of words that one edit apart, both ways round."""
    spark = vocabulary.sparkSession
    # At most the 26 letters and 64 others that runs may have.
    letters = sorted(r.c for r in vocabulary.select(F.explode(F.split("word", "")).alias("c")).distinct().collect() if r.c)
    alphabet = "".join(letters)
    wanted = spark.sparkContext.broadcast(vocabulary_filter(vocabulary))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, keys, strings = batch.column(0).to_pylist(), [], []
            for k, string in neighbourhood(found, alphabet, wanted.value):
                keys.append(found[k])
                strings.append(string)
                if len(keys) == 1 << 14:
                    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(strings, pa.string())], ["word", "near"])
                    keys, strings = [], []
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(strings, pa.string())], ["word", "near"])

    tasks = 1 + vocabulary.count() // TASK_WORDS
    return vocabulary.select("word").repartition(tasks).mapInArrow(emit, "word string, near string")


def roots(forms: DataFrame) -> DataFrame:
    """word, root: the last word that forms (word, form) lead to. Counts at least double with each form, so doubled jumps end soon."""
    jumps = materialize(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        far = jumps.select(F.col("word").alias("root"), F.col("root").alias("far"))
        new = materialize(jumps.join(far, "root", "left").select("word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")), "spelling-roots")
        discard(jumps)
        if not new.filter("moved").limit(1).count():
            return new.select("word", "root")
        jumps = new.drop("moved")
        jumps.folder = new.folder


def spelling_variants(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, form, root, n, n_near, form_n of each word of at least 5 code points that occurs at least 3 times.

    Null and empty texts have no words, an empty table gives no rows. Rows stated
    twice count twice, and a null id enters the hash of its runs as an empty one.
    Of near words that occur equally often the smallest one by code points is
    the form. Runs may be as long as texts; their candidates are made in pieces.
    Further columns may have any names.
    """
    vocabulary = materialize(words(df, id_col, text_col), "spelling-words")
    near = vocabulary.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    met = near_words(vocabulary).join(near, "near")
    best: Column = F.min(F.struct(-F.col("near_n"), F.col("near")))
    found = met.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    found = vocabulary.join(found.select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.col1")).alias("near_n")), "word", "left")
    is_form = F.col("near_n") >= FORM_FACTOR * F.col("n")
    found = found.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("near")).alias("form"), F.when(is_form, F.col("near_n")).alias("form_n"))
    found = materialize(found, "spelling-forms")
    last = roots(found.filter("form is not null"))
    out = found.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
    discard(vocabulary)
    return out
