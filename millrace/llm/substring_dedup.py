"""Removal of word windows that occurred earlier, behind a count-min prefilter.

Every task counts its windows' anchors (see ``hashing.owned_runs``) in a
count-min sketch as wide as the table's bytes ask for; the merged sketch never
counts less than there are. A second pass takes exactly the runs whose anchors
the sketch estimates as repeated. Of runs with one content, all but the first
go whole; the first ones of anchors with several contents are compared window
by window.

A merged sketch of up to ``BROADCAST_CELLS`` goes to the tasks as a bitmap.
A wider one stays a table of its occupied cells, and runs join it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import runs
from millrace.llm.common import bytes_list, cuts, discard, materialize
from millrace.llm.hashing import U, Prefix, mix, owned_runs, words_of

WINDOW, GRAM = 20, 8
#: Bytes of text for each cell of a sketch row. About 40 bytes bring one anchor: 0.4 anchors a cell, and of the
#: anchors that occur once (1 - exp(-0.4))**2 = 0.11 pass two rows.
CELL_BYTES = 16
#: Rows of a bitmap, cells of one of its blocks, and most cells of a row (ROWS * BROADCAST_CELLS / 8 bytes are broadcast).
ROWS, BLOCK, BROADCAST_CELLS = 2, 1 << 20, 1 << 27
#: The only row of a table of cells is so many times wider: 0.05 anchors a cell, and 0.05 of the single ones pass.
WIDER = 8
#: Anchors that a task holds before it sends its sketch.
HELD = 1 << 22
_REST = re.compile(rb"(?:[\x20\x09-\x0D]*[^\x20\x09-\x0D]+){0,%d}" % (WINDOW - 1))
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def word_pieces(texts: list[bytes], size: int = runs.PIECE) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(pieces, text, bytes of its own) of texts cut between words; a piece also has the 19 words after it."""
    pieces, owner, own = [], [], []
    for i, t in enumerate(texts):
        lo = 0
        while True:
            cut = _SPACE.search(t, lo + size) if lo + size < len(t) else None
            hi = cut.start() if cut else len(t)
            pieces.append(t[lo:hi] + _REST.match(t, hi)[0] if cut else t[lo:])
            owner.append(i)
            own.append(hi - lo)
            if not cut:
                break
            lo = hi
    return pieces, np.array(owner, np.int64), np.array(own, np.int64)


def piece_words(texts: list[bytes], size: int = runs.PIECE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(two hashes of each word, first word of each piece and the end, text of each piece, words of its text before each piece)."""
    pieces, owner, own = word_pieces(texts, size)
    hashes, start, _, first = words_of(pieces)
    at = np.concatenate([[0], np.cumsum([len(p) + 1 for p in pieces])])[:-1]
    n_own = np.searchsorted(start, at + own) - first[:-1]
    before = np.cumsum(n_own) - n_own
    head = np.searchsorted(owner, owner)
    return hashes, first, owner, before - before[head]


def word_runs(texts: list[bytes], size: int = runs.PIECE) -> runs.Runs:
    hashes, first, text, before = piece_words(texts, size)
    piece, start, n, key, _ = owned_runs(hashes[0], first, WINDOW, GRAM)
    c1, c2 = (Prefix(h).stretches(start, n + WINDOW - 1) for h in hashes)
    return text[piece], {"key": key.view(np.int64), "c1": c1.view(np.int64), "c2": c2.view(np.int64), "start": start - first[piece] + before[piece], "n": n.astype(np.int32)}


def anchors(texts: list[bytes]) -> np.ndarray:
    hashes, first, _, _ = piece_words(texts)
    return owned_runs(hashes[0], first, WINDOW, GRAM)[3]


def cells(key: np.ndarray, row: int, width: int) -> np.ndarray:
    return (mix(key + U(row * 0x632BE59BD9B4E019 & 0xFFFFFFFFFFFFFFFF)) % U(width)).astype(np.int64)


def held_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    held, n = [], 0
    for batch in batches:
        for lo, hi in cuts(batch, "text", runs.CHUNK):
            held.append(anchors(bytes_list(batch.slice(lo, hi - lo).column("text"))))
            n += len(held[-1])
        if n >= HELD:
            yield np.concatenate(held)
            held, n = [], 0
    if n:
        yield np.concatenate(held)


def partition_sketches(docs: DataFrame, width: int) -> DataFrame:
    """row, block, once, twice: the sketches of the tasks by block, counts from 2 on as one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for every in held_anchors(batches):
            for row in range(ROWS):
                cell, n = np.unique(cells(every, row, width), return_counts=True)
                at = np.searchsorted(cell, np.arange(0, width + 1, BLOCK))
                out = [(row, b, (cell[x:y] % BLOCK).astype(np.uint32), n[x:y] > 1) for b, (x, y) in enumerate(zip(at[:-1], at[1:], strict=True)) if y > x]
                yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.int32()), pa.array([o[2][~o[3]].tobytes() for o in out], pa.binary()), pa.array([o[2][o[3]].tobytes() for o in out], pa.binary())], ["row", "block", "once", "twice"])

    return docs.select("text").mapInArrow(run, "row int, block int, once binary, twice binary")


def merged_sketch(docs: DataFrame, width: int) -> np.ndarray:
    """(rows, width / 8) of bits: the count of the cell is above one."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for row, block, once, twice in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                c = counts.setdefault((row, block), np.zeros(BLOCK, np.uint8))
                at = np.frombuffer(once, np.uint32)
                c[at] = np.minimum(2, c[at] + 1)
                c[np.frombuffer(twice, np.uint32)] = 2
        keys = list(counts)
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()), pa.array([np.packbits(counts[k] > 1).tobytes() for k in keys], pa.binary())], ["row", "block", "bits"])

    out = np.zeros((ROWS, width // BLOCK, BLOCK // 8), np.uint8)
    merged = partition_sketches(docs, width).repartition("row", "block").mapInArrow(merge, "row int, block int, bits binary")
    for r in merged.collect():  # ROWS * BROADCAST_CELLS / 8 bytes at most
        out[r["row"], r["block"]] = np.frombuffer(r["bits"], np.uint8)
    return out.reshape(ROWS, -1)


def repeated_cells(docs: DataFrame, width: int) -> DataFrame:
    """cell: the occupied cells of the merged sketch that count above one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for every in held_anchors(batches):
            cell, n = np.unique(cells(every, 0, width), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(np.minimum(n, 2).astype(np.int32))], ["cell", "n"])

    counts = docs.select("text").mapInArrow(run, "cell long, n int").groupBy("cell").agg(F.sum("n").alias("n"))
    return counts.filter("n > 1").select("cell")


RUN = "key long, c1 long, c2 long, start long, n int"


def estimated_repeated(docs: DataFrame, broadcast_cells: int) -> DataFrame:
    """The runs whose anchors the sketch counts above one."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    width = max(BLOCK, 1 << max(0, size // CELL_BYTES - 1).bit_length())
    if width <= broadcast_cells:
        sketch = docs.sparkSession.sparkContext.broadcast(merged_sketch(docs, width))

        def repeated(texts: list[bytes]) -> runs.Runs:
            owner, found = word_runs(texts)
            ok = np.ones(len(owner), bool)
            for row in range(ROWS):
                c = cells(found["key"].view(U), row, width)
                ok &= (sketch.value[row][c >> 3] >> (7 - (c & 7)).astype(np.uint8) & 1).astype(bool)
            return owner[ok], {k: v[ok] for k, v in found.items()}

        return runs.run_rows(docs, repeated, RUN)
    wide = WIDER * width

    def celled(texts: list[bytes]) -> runs.Runs:
        owner, found = word_runs(texts)
        return owner, {**found, "cell": cells(found["key"].view(U), 0, wide)}

    return runs.run_rows(docs, celled, RUN + ", cell long").join(materialize(repeated_cells(docs, wide), "window-cells"), "cell", "left_semi").drop("cell")


def window_rows(docs: DataFrame, firsts: DataFrame) -> DataFrame:
    """w1, w2, did, rid, start of every window of the runs that are the first of their content."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            did, rid, spans = batch.column("did").to_numpy(), batch.column("rid").to_numpy(), batch.column("spans")
            for lo, hi in cuts(batch, "text", runs.CHUNK):
                hashes, _, _, first = words_of(bytes_list(batch.slice(lo, hi - lo).column("text")))  # a long text is one slice
                start = [runs.struct_column(spans, i, "start") for i in range(lo, hi)]
                n = [runs.struct_column(spans, i, "n").astype(np.int64) for i in range(lo, hi)]
                own = np.repeat(np.arange(hi - lo), [int(x.sum()) for x in n])
                s, k = np.concatenate([np.zeros(0, np.int64), *start]), np.concatenate([np.zeros(0, np.int64), *n])
                at = np.repeat(s, k) + np.arange(int(k.sum())) - np.repeat(np.cumsum(k) - k, k)
                unit = at + first[own]
                size = np.full(len(unit), WINDOW)
                w1, w2 = (Prefix(h).stretches(unit, size) for h in hashes)
                yield pa.RecordBatch.from_arrays([pa.array(w1.view(np.int64)), pa.array(w2.view(np.int64)), pa.array(did[lo + own]), pa.array(rid[lo + own]), pa.array(at)], ["w1", "w2", "did", "rid", "start"])

    # Equal rows give equal windows twice; their places are equal too, so none counts as later.
    return runs.with_texts(docs.select("did", "rid", "text"), runs.by_document(firsts, "start", "n"), "inner").select("did", "rid", "text", "spans").mapInArrow(run, "w1 long, w2 long, did long, rid long, start long")


def place() -> Column:
    return F.struct("did", "rid", "start")


def finish(docs: DataFrame, spans: DataFrame, keep: bool) -> DataFrame:
    """Remove the covered words of every text; without spans (null and empty texts, empty tables) nothing goes."""
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long, n_removed long, kept_sha256 string" + ", kept string" * keep

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in cuts(batch, "text", 4 * runs.CHUNK):
                part = batch.slice(lo, hi - lo)
                spans, out = part.column("spans"), []
                for i, text in enumerate(bytes_list(part.column("text"))):
                    words = text.split()
                    start = runs.struct_column(spans, i, "start")
                    n = len(words)
                    if len(start):
                        edge = np.zeros(n + 1, np.int64)
                        np.add.at(edge, start, 1)
                        np.add.at(edge, start + runs.struct_column(spans, i, "n") + WINDOW - 1, -1)
                        words = [words[k] for k in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]
                    out.append((n, n - len(words), b" ".join(words)))
                cols = [part.column("doc_id"), pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int64()), pa.array([hashlib.sha256(r[2]).hexdigest() for r in out], pa.string())]
                cols += [pa.array([r[2].decode() for r in out], pa.string())] * keep
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_words", "n_removed", "kept_sha256", *["kept"] * keep])

    return runs.with_texts(docs, runs.by_document(spans, "start", "n"), "left").select("doc_id", "text", "spans").mapInArrow(remove, schema)


def remove_earlier_windows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: bool = False, broadcast_cells: int = BROADCAST_CELLS) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (and the kept text) of each row.

    A word goes if a window of 20 words over it also starts earlier: in a
    smaller doc_id, or before in its own text. Null text has no words; a null
    id comes before all others. Rows equal in id and text are one document
    stated twice: neither is earlier than the other. Of different texts under
    one id, the one of the lesser hash is the earlier.
    """
    docs = runs.keyed(df, id_col, text_col)
    met = materialize(estimated_repeated(docs, broadcast_cells), "window-runs")
    grouped = met.groupBy("key", "c1", "c2").agg(F.count(F.lit(1)).alias("copies"), F.min(place()).alias("first"), F.first("n").alias("n"))
    contents = materialize(grouped, "window-contents")
    again = contents.filter("copies > 1").select("key", "c1", "c2", "first")
    whole = materialize(met.join(again, ["key", "c1", "c2"]).filter(place() != F.col("first")).select("did", "rid", "start", "n"), "window-spans")
    mixed = materialize(contents.groupBy("key").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1").select("key"), "window-keys")
    windows = materialize(window_rows(docs, contents.join(mixed, "key", "left_semi").select("first.*", "n")), "windows")
    discard(met, contents, mixed)
    firsts = materialize(windows.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("c"), F.min(place()).alias("first")).filter("c > 1").drop("c"), "window-firsts")
    later = materialize(windows.join(firsts, ["w1", "w2"]).filter(place() != F.col("first")).select("did", "rid", "start", F.lit(1).alias("n")), "window-spans")
    discard(windows, firsts)
    return finish(docs, whole.unionAll(later), keep)
