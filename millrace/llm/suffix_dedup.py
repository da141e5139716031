"""Exact removal of repeated byte strings with suffix arrays by deep-shallow sorting.

A string of 200 bytes can repeat only under the same anchor (see
``hashing.owned_runs``) and at the same place relative to it, so suffixes are
sorted anchor by anchor instead of all at once, which spreads the array over
the cluster without shuffling a suffix of every byte. Runs of windows with one
anchor and equal contents (by SHA-256) are one block with a number of copies;
one occurrence of each block brings its bytes. Where an anchor has blocks of
several contents, their suffixes are sorted: ternary multikey quicksort on
eight bytes at a time to a shallow depth, then blind tries for what still
shares a prefix. Equal neighbours in that order, or a block with copies, are
repeats.

An anchor may be hot: a passage that very many texts share stands in blocks of
as many contents where it meets their own words. Its windows are then dealt by
place to ``SLOTS``, and the anchor grows to all bytes that the windows of a
slot have in common. What is still hot is dealt once more, to single windows,
whose key is the window itself and whose contents are therefore one. No block
is held by two keys for the same window, and no key has more than
``KEY_BLOCKS`` contents to sort.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import runs
from millrace.llm.common import bytes_list, cuts, discard, materialize
from millrace.llm.hashing import BYTES, owned_runs

LENGTH = 200
#: Bytes of an anchor.
GRAM = 50
#: Depth to which multikey quicksort goes.
SHALLOW = 40
#: Bytes of blocks that are sorted at once; a key's blocks stay together.
SORT_BYTES = 1 << 20
#: Contents of a key that are sorted as they are; the windows of a key with more are dealt to longer keys.
KEY_BLOCKS = 1024
#: Windows of a slot, by how often a key was dealt.
SLOTS = (19, 1)
#: Blocks of hot keys that are dealt at once.
DEAL_ROWS = 4096
#: Columns of a run: key, content (128 bits), first window, windows, bytes before the anchor; of a block; of its repeats.
RUN = "key long, c1 long, c2 long, start long, n int, ahead int"
BLOCK = "key long, c1 long, c2 long, copies long, ahead int, kinds long, block binary"
REPEATS = "key long, c1 long, c2 long, spans array<struct<o:int,k:int>>"


def pieces_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``owned_runs`` of all texts, places in their text; those beyond ``runs.PIECE`` bytes go in overlapping pieces."""
    pieces, own, shift = [], [], []
    for i, t in enumerate(texts):
        for lo in range(0, max(1, len(t) - LENGTH + 1), runs.PIECE):
            pieces.append(t[lo : lo + runs.PIECE + LENGTH - 1])
            own.append(i)
            shift.append(lo)
    buf = np.frombuffer(b"".join(pieces), np.uint8)
    first = np.concatenate([[0], np.cumsum([len(p) for p in pieces])]).astype(np.int64)
    owner, start, n, ahash, anchor = owned_runs(BYTES[buf], first, LENGTH, GRAM)
    return np.array(own, np.int64)[owner], start - first[owner] + np.array(shift, np.int64)[owner], n, ahash.view(np.int64), (anchor - start).astype(np.int32)


def digests(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each part's SHA-256, as two numbers."""
    x = np.frombuffer(b"".join([hashlib.sha256(p).digest()[:16] for p in parts]), np.int64).reshape(-1, 2)
    return np.ascontiguousarray(x[:, 0]), np.ascontiguousarray(x[:, 1])


def anchors(texts: list[bytes]) -> runs.Runs:
    owner, _, _, key, _ = pieces_of(texts)
    return owner, {"key": key}


def byte_runs(texts: list[bytes]) -> runs.Runs:
    owner, start, n, key, ahead = pieces_of(texts)
    c1, c2 = digests([texts[i][a : a + k + LENGTH - 1] for i, a, k in zip(owner.tolist(), start.tolist(), n.tolist(), strict=True)])
    return owner, {"key": key, "c1": c1, "c2": c2, "start": start, "n": n.astype(np.int32), "ahead": ahead}


def common_bytes(words: np.ndarray, p: np.ndarray, q: np.ndarray, depth: int, limit: int) -> np.ndarray:
    """Common prefix of suffixes p and q, known to share ``depth`` bytes, up to ``limit``."""
    out = np.full(len(p), limit, np.int64)
    alive = np.arange(len(p))
    for d in range(depth, limit, 8):
        x = words[p[alive] + d] ^ words[q[alive] + d]
        differ = x != 0
        # The highest set bit of the difference tells the first differing byte.
        high = x[differ]
        zeros = np.zeros(len(high), np.int64)
        for k in range(1, 8):
            zeros += high < (np.uint64(1) << np.uint64(64 - 8 * k))
        out[alive[differ]] = np.minimum(limit, d + zeros)
        alive = alive[~differ]
        if not len(alive):
            break
    return out


def deep_shallow(buf: np.ndarray, starts: np.ndarray, limit: int = LENGTH, shallow: int = SHALLOW, bucket: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(order, group): suffixes by bucket and their first ``limit`` bytes, and for each place the first place of equal ones."""
    padded = np.concatenate([buf, np.zeros(limit + 16, np.uint8)]).astype(np.uint64)
    words = (padded[:-1] << np.uint64(8)) | padded[1:]
    words = (words[:-2] << np.uint64(16)) | words[2:]
    words = (words[:-4] << np.uint64(32)) | words[4:]
    order, group = np.arange(len(starts)), np.zeros(len(starts), np.int64)
    if bucket is not None and len(starts):
        order = np.argsort(bucket, kind="stable")
        new = np.concatenate([[True], np.diff(bucket[order]) != 0])
        group = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))

    def shared(active: np.ndarray) -> np.ndarray:
        """The active places whose group has another member; whole groups are active."""
        g = group[active]
        new = np.concatenate([[True], g[1:] != g[:-1]]) if len(g) else np.zeros(0, bool)
        return active[~(new & np.concatenate([new[1:], [True]]))]

    def deal(active: np.ndarray, part: np.ndarray) -> np.ndarray:
        """Members of each group in the order of ``part`` (a byte), as groups of their own; how they were moved."""
        key = group[active] * 256 + part
        by = np.argsort(key, kind="stable")  # groups stand in order already, so few are moved far
        order[active] = order[active][by]
        new = np.concatenate([[True], np.diff(key[by]) != 0])
        group[active] = active[np.maximum.accumulate(np.where(new, np.arange(len(active)), 0))]
        return by

    # Ternary multikey quicksort, the groups of all anchors at once: every group is parted
    # by the median of three of its words into less, equal and greater; the equal part
    # moves on by eight bytes, the others stay at their depth.
    depth = np.zeros(len(starts), np.int64)
    active = shared(np.arange(len(starts)))
    while len(active):
        at = depth[active]
        word = words[starts[order[active]] + at]
        over = at + 8 > limit  # the last bytes of the limit only
        if over.any():
            word[over] >>= (8 * (at[over] + 8 - limit)).astype(np.uint64)
        head = np.flatnonzero(np.concatenate([[True], group[active][1:] != group[active][:-1]]))
        size = np.diff(np.concatenate([head, [len(active)]]))
        three = np.sort(np.stack([word[head], word[head + size // 2], word[head + size - 1]]), axis=0)
        pivot = np.repeat(three[1], size)
        part = 1 + (word > pivot).astype(np.int64) - (word < pivot)
        by = deal(active, part)
        depth[active] = at[by] + 8 * (part[by] == 1)
        active = shared(active)
        active = active[depth[active] < min(shallow, limit)]
    # Blind tries, all groups at once and breadth first: a node holds only the depth
    # at which its suffixes part and the bytes that part them; depths come from
    # comparing every member with one, the node's first.
    active = shared(np.arange(len(starts)))
    known = min(shallow, limit) // 8 * 8
    while len(active):
        here = starts[order[active]]
        lcp = common_bytes(words, here, starts[order[group[active]]], known, limit)
        head = np.flatnonzero(np.concatenate([[True], group[active][1:] != group[active][:-1]]))
        parts_at = np.repeat(np.minimum.reduceat(lcp, head), np.diff(np.concatenate([head, [len(active)]])))
        open_ = parts_at < limit
        active, here, parts_at = active[open_], here[open_], parts_at[open_]
        if len(active):
            deal(active, (words[here + parts_at] >> np.uint64(56)).astype(np.int64))
            active = shared(active)
    return order, group


def repeated_windows(blocks: list[bytes], copies: np.ndarray, bucket: np.ndarray, ahead: np.ndarray, limit: int = LENGTH) -> list[np.ndarray]:
    """For each block the offsets of its strings of ``limit`` bytes that occur more than once.

    Strings are equal only if their blocks are in one bucket and they stand at
    one distance from the anchor, ``ahead`` bytes into the block.
    """
    first = np.concatenate([[0], np.cumsum([len(b) for b in blocks])]).astype(np.int64)
    buf = np.frombuffer(b"".join(blocks), np.uint8)
    size = np.diff(first) - limit + 1
    owner = np.repeat(np.arange(len(blocks)), size)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
    starts = offset + first[:-1][owner]
    distance = ahead[owner] - offset
    place = bucket[owner] * (2 * limit) + distance + limit
    order, group = deep_shallow(buf, starts, limit, bucket=place)
    times = np.bincount(group, weights=copies[owner][order], minlength=len(group))[group] if len(group) else np.zeros(0)
    hit = np.sort(order[times > 1])
    at = np.searchsorted(owner[hit], np.arange(len(blocks) + 1))
    return [offset[hit[a:b]] for a, b in zip(at[:-1], at[1:], strict=True)]


def spans_of(offsets: np.ndarray) -> list[dict[str, int]]:
    """Ascending offsets as runs."""
    if not len(offsets):
        return []
    cut = np.flatnonzero(np.diff(offsets) > 1)
    lo, hi = np.concatenate([[0], cut + 1]), np.concatenate([cut, [len(offsets) - 1]])
    return [{"o": int(offsets[a]), "k": int(offsets[b] - offsets[a] + 1)} for a, b in zip(lo, hi, strict=True)]


def sort_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks sorted by (key, c1, c2) to the repeats of each; chunks end between keys."""

    def solve(part: pa.Table) -> pa.RecordBatch:
        key, c1, c2, copies, ahead = (part.column(c).to_numpy() for c in ("key", "c1", "c2", "copies", "ahead"))
        # A row that is stated twice brings its block twice.
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (c1[1:] != c1[:-1]) | (c2[1:] != c2[:-1])])
        blocks = part.column("block").filter(pa.array(new)).to_pylist()
        key, c1, c2, copies, ahead = key[new], c1[new], c2[new], copies[new], ahead[new]
        bucket = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]]))
        spans = [spans_of(f) for f in repeated_windows(blocks, copies, bucket, ahead)]
        return pa.RecordBatch.from_arrays([pa.array(key), pa.array(c1), pa.array(c2), pa.array(spans, pa.list_(pa.struct([("o", pa.int32()), ("k", pa.int32())])))], ["key", "c1", "c2", "spans"])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.nbytes for b in held) < SORT_BYTES:
            continue
        table = pa.Table.from_batches(held)
        key = table.column("key").to_numpy()
        last = np.flatnonzero(key[1:] != key[:-1])
        if len(last):
            cut = int(last[-1]) + 1
            yield solve(table.slice(0, cut))
            table = table.slice(cut)
        held = table.to_batches()
    if held:
        yield solve(pa.Table.from_batches(held))


def blocks_of(docs: DataFrame, contents: DataFrame) -> DataFrame:
    """key, c1, c2, copies, ahead, kinds, block of contents (and the place of one occurrence), cut from their texts."""
    kept = ("key", "c1", "c2", "copies", "ahead", "kinds")
    lists = runs.by_document(contents, *kept, "start", "n")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in cuts(batch, "text", runs.CHUNK):
                part = batch.slice(lo, hi - lo)
                spans = pa.concat_arrays([part.column("spans")]).flatten()
                own = np.repeat(np.arange(hi - lo), part.column("spans").value_lengths().to_numpy(zero_copy_only=False))
                texts = bytes_list(part.column("text"))
                blocks = [texts[i][a : a + n + LENGTH - 1] for i, a, n in zip(own.tolist(), spans.field("start").to_pylist(), spans.field("n").to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*(spans.field(c) for c in kept), pa.array(blocks, pa.binary())], [*kept, "block"])

    return runs.with_texts(docs.select("did", "rid", "text"), lists, "inner").select("text", "spans").mapInArrow(cut, BLOCK)


def longer_keys(hot: DataFrame, width: int) -> DataFrame:
    """Blocks of hot keys dealt to slots of ``width`` distances from the anchor, each under a longer key.

    The windows whose anchor is d bytes in, d from ``slot * width`` on, all
    have the bytes from the last one's start to the first one's end. Columns
    p0, p1, p2 and o name the block that a part is of and where it starts there.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, DEAL_ROWS):
                part = batch.slice(at, DEAL_ROWS)
                blocks = part.column("block").to_pylist()
                p0, p1, p2, copies, ahead = (part.column(c).to_numpy() for c in ("key", "c1", "c2", "copies", "ahead"))
                ahead, n = ahead.astype(np.int64), np.array([len(b) - LENGTH + 1 for b in blocks])
                # A block's windows are ahead, ahead - 1, ... bytes before the anchor.
                top, slots = ahead // width, ahead // width - (ahead - n + 1) // width + 1
                own = np.repeat(np.arange(len(blocks)), slots)
                slot = top[own] - (np.arange(len(own)) - np.repeat(np.cumsum(slots) - slots, slots))
                first = np.minimum(ahead[own], slot * width + width - 1)
                last = np.maximum(ahead[own] - n[own] + 1, slot * width)
                o = ahead[own] - first
                common = ahead[own] - slot * width  # where the nearest window starts; the farthest ends a width earlier than its end
                listed = list(zip(own.tolist(), slot.tolist(), common.tolist(), strict=True))
                key, _ = digests([blocks[i][c : c - width + 1 + LENGTH] + b"%d" % s for i, s, c in listed])
                parts = [blocks[i][a : a + k + LENGTH] for i, a, k in zip(own.tolist(), o.tolist(), (first - last).tolist(), strict=True)]
                c1, c2 = digests(parts)
                cols = [key ^ p0[own], c1, c2, copies[own], first.astype(np.int32), pa.array(parts, pa.binary()), p0[own], p1[own], p2[own], o.astype(np.int32)]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in cols], ["key", "c1", "c2", "copies", "ahead", "block", "p0", "p1", "p2", "o"])

    return hot.mapInArrow(deal, "key long, c1 long, c2 long, copies long, ahead int, block binary, p0 long, p1 long, p2 long, o int")


def repeats_in(blocks: DataFrame, widths: tuple[int, ...], key_blocks: int, scratch: list[DataFrame]) -> DataFrame:
    """key, c1, c2 and the repeated windows (offset o, number k) of blocks under keys with several contents; ``scratch`` gets the tables it reads."""
    few = blocks.filter(F.col("kinds") <= key_blocks) if widths else blocks
    ordered = few.select("key", "c1", "c2", "copies", "ahead", "block").repartition("key").sortWithinPartitions("key", "c1", "c2")
    found = ordered.mapInArrow(sort_blocks, REPEATS).filter(F.size("spans") > 0)
    hot = blocks.filter(F.col("kinds") > key_blocks)
    if not widths or not hot.limit(1).count():
        return found
    parts = materialize(longer_keys(hot, widths[0]), "repeat-parts")
    contents = materialize(parts.groupBy("key", "c1", "c2").agg(F.sum("copies").alias("copies"), F.first("ahead").alias("ahead"), F.first("block").alias("block")), "repeat-contents")
    kinds = materialize(several(contents), "repeat-keys")
    inner = repeats_in(contents.join(kinds, "key"), widths[1:], key_blocks, scratch)
    scratch += [parts, contents, kinds]
    whole = contents.join(kinds, "key", "left_anti").select("key", "c1", "c2", "copies", (F.length("block") - LENGTH + 1).alias("n"))
    # Back to the blocks that the parts are of; one block's parts don't overlap.
    of_parts = parts.select("key", "c1", "c2", "p0", "p1", "p2", F.col("o").alias("at"))
    back = of_parts.join(inner.unionAll(alone(whole)), ["key", "c1", "c2"])
    shifted = F.transform("spans", lambda x: F.struct((x["o"] + F.col("at")).alias("o"), x["k"].alias("k")))
    back = back.groupBy("p0", "p1", "p2").agg(F.flatten(F.collect_list(shifted)).alias("spans"))
    return found.unionAll(back.select(F.col("p0").alias("key"), F.col("p1").alias("c1"), F.col("p2").alias("c2"), "spans"))


def several(contents: DataFrame) -> DataFrame:
    """The keys with more than one content, and how many they have."""
    return contents.groupBy("key").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1")


def alone(contents: DataFrame) -> DataFrame:
    """The repeats of contents that are their key's only one: their windows differ, and each occurs as often as the content."""
    return contents.filter("copies > 1").select("key", "c1", "c2", F.array(F.struct(F.lit(0).alias("o"), F.col("n").alias("k"))).alias("spans"))


def finish(docs: DataFrame, spans: DataFrame, keep: bool) -> DataFrame:
    """Remove the covered bytes of every text; without spans (null and empty texts, empty tables) nothing goes."""
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in cuts(batch, "text", 4 * runs.CHUNK):
                part = batch.slice(lo, hi - lo)
                out: list[tuple] = []
                spans = part.column("spans")
                for i, text in enumerate(bytes_list(part.column("text"))):
                    start = runs.struct_column(spans, i, "start")
                    if not len(start):
                        out.append((len(text), 0, 0, text))
                        continue
                    end = start + runs.struct_column(spans, i, "n") + LENGTH - 1
                    by = np.argsort(start, kind="stable")
                    start, end = start[by], np.maximum.accumulate(end[by])
                    new = np.concatenate([[True], start[1:] > end[:-1]])  # touching spans are one run of removed bytes
                    a, b = start[new], end[np.concatenate([new[1:], [True]])]
                    at = np.concatenate([[0], b])
                    kept = b"".join([text[x:y] for x, y in zip(at, [*a, len(text)], strict=True)])
                    out.append((len(text), len(text) - len(kept), len(a), kept))
                cols = [part.column("doc_id"), *(pa.array([r[k] for r in out], pa.int64()) for k in range(3)), pa.array([hashlib.sha256(r[3]).hexdigest() for r in out], pa.string())]
                cols += [pa.array([r[3] for r in out], pa.binary())] * keep
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept"] * keep])

    return runs.with_texts(docs, runs.by_document(spans, "start", "n"), "left").select("doc_id", "text", "spans").mapInArrow(remove, schema)


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: bool = False, key_blocks: int = KEY_BLOCKS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and the kept bytes) of each row.

    A byte goes if a string of 200 bytes over it also starts elsewhere in the
    table, in the same text or any other. Null text counts as empty; texts
    under 200 bytes stay whole. Repeated rows are copies of each other, so
    nothing of 200 bytes is left of them; null ids are ids like others.
    """
    docs = runs.keyed(df, id_col, text_col)
    shared = runs.run_rows(docs, anchors, "key long", keyed=False).groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("key")
    shared = materialize(shared, "repeat-anchors")
    met = materialize(runs.run_rows(docs, byte_runs, RUN).join(shared, "key", "left_semi"), "repeat-runs")
    discard(shared)
    place = F.min(F.struct("did", "rid", "start", "n", "ahead")).alias("at")
    contents = materialize(met.groupBy("key", "c1", "c2").agg(F.count(F.lit(1)).alias("copies"), place).select("key", "c1", "c2", "copies", "at.*"), "repeat-contents")
    kinds = materialize(several(contents), "repeat-keys")
    blocks = materialize(blocks_of(docs, contents.join(kinds, "key")), "repeat-blocks")
    scratch = [met, contents, kinds, blocks]
    repeats = repeats_in(blocks, SLOTS, key_blocks, scratch).unionAll(alone(contents.join(kinds, "key", "left_anti")))
    repeats = materialize(repeats, "repeats")
    spans = met.join(repeats, ["key", "c1", "c2"]).select("did", "rid", "start", F.inline("spans"))
    spans = materialize(spans.select("did", "rid", (F.col("start") + F.col("o")).alias("start"), F.col("k").alias("n")), "repeat-spans")
    discard(*scratch, repeats)
    return finish(docs, spans, keep)
