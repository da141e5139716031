"""Byte-level BPE by a rank file: encoding as a tree of joins, decoding as a tree of concatenations.

Encodings of neighbouring stretches form a monoid: the halves are encoded and
joined by re-encoding a window around the seam, which grows until the tokens
outside cannot change. What proves that differs by level:

* Inside a match of the pattern, a sequence of tokens is the encoding of its
  bytes if and only if every two neighbours are the encoding of their own
  bytes. So a window is wide enough when both of its seams are such pairs.
* Between matches, a window is wide enough when both of its edges lie on a
  *safe cut*, a place between a letter and a space with a letter after it.
  Whatever stands on either side, the pattern ends one match there and starts
  another (its letter runs end before a space, and a space with a letter after
  it can only open a match), and merges stay inside a match.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import cuts, rows_of

#: Bytes of a match up to which merges are taken one by one, and characters of a text that are split into matches at once.
LEAF_BYTES, LEAF_CHARS = 16, 4096
#: Tokens on either side of a seam that the first window of a match covers.
FIRST_TOKENS = 2
#: Tokens of a window beyond which a match is merged as one.
MOST_TOKENS = 512
#: Bytes up to which a scan of all pairs finds the next merge sooner than a heap.
SCANNED_BYTES = 48
#: Matches that a worker remembers, in each of two generations.
REMEMBERED = 1 << 18
#: Characters on either side of a seam that the first window covers.
FIRST_WINDOW = 64
#: ASCII letters only: safe for any pattern in which they are letters.
SAFE_CUT = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")


class Codec:
    def __init__(self, ranks: dict[bytes, int], pattern: str, leaf_chars: int = LEAF_CHARS, leaf_bytes: int = LEAF_BYTES):
        import regex

        self.leaf_chars, self.leaf_bytes = leaf_chars, leaf_bytes
        self.ranks = ranks
        compiled = regex.compile(pattern)
        self.matches = compiled.findall if not compiled.groups else lambda text: [m[0] for m in compiled.finditer(text)]
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for k, v in ranks.items():
            self.bytes_of[v] = k
        self.decimal = [str(i) for i in range(len(self.bytes_of))]
        self.known: dict[str, list[int]] = {}
        self.older: dict[str, list[int]] = {}
        self.pairs: dict[tuple[int, int], bool] = {}

    @classmethod
    def load(cls, path: str, pattern: str) -> Codec:
        with open(path, "rb") as lines:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}, pattern)

    def encode(self, text: str) -> list[int]:
        return self.tree(text, 0, len(text))

    def leaf(self, text: str) -> list[int]:
        """Ids of a text, match by match."""
        ids = []
        for word in self.matches(text):
            try:
                ids += self.known[word]
            except KeyError:
                ids += self.match(word)
        return ids

    def match(self, word: str) -> list[int]:
        """Ids of one match; a token where the whole of it is one."""
        raw = word.encode()
        got = self.older.get(word) or ([self.ranks[raw]] if raw in self.ranks else self.merged(raw))
        if got is None:  # no seam of it settles, as in a long run of one character
            got = self.merges(raw)
        if len(word) <= 64:
            if len(self.known) >= REMEMBERED:
                self.older, self.known = self.known, {}
            self.known[word] = got
        return got

    def merged(self, raw: bytes) -> list[int] | None:
        """Ids of a match, or of any bytes without a break in them: halves, joined. None if a window outgrows both halves of many."""
        if len(raw) <= self.leaf_bytes:
            return self.merges(raw)
        mid = len(raw) // 2
        left = self.merged(raw[:mid])
        right = self.merged(raw[mid:]) if left is not None else None
        width = FIRST_TOKENS
        while right is not None:
            a, b = max(0, len(left) - width), min(len(right), width)
            window = b"".join(map(self.bytes_of.__getitem__, left[a:] + right[:b]))
            middle = self.merges(window)
            if (a == 0 or self.fits(left[a - 1], middle[0])) and (b == len(right) or self.fits(middle[-1], right[b])):
                return left[:a] + middle + right[b:]
            if width > MOST_TOKENS:
                return None
            width *= 2
        return None

    def merges(self, raw: bytes) -> list[int]:
        """The merge of least rank, leftmost first, until none is left; of many bytes, neighbours in linked lists and merges in a heap."""
        n = len(raw)
        if n <= SCANNED_BYTES:
            return self.merges_of_few(raw)
        end, before, after = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        rank = self.ranks.get
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(raw[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = end[i]
            if j == 0 or j >= n or end[j] != stop:  # either part has been merged since
                continue
            end[i], end[j] = stop, 0
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                if (r := rank(raw[i : end[after[i]]])) is not None:
                    heapq.heappush(heap, (r, i, end[after[i]]))
            if before[i] >= 0 and (r := rank(raw[before[i] : stop])) is not None:
                heapq.heappush(heap, (r, before[i], stop))
        ids, i = [], 0
        while i < n:
            ids.append(self.ranks[raw[i : end[i]]])
            i = end[i]
        return ids

    def merges_of_few(self, raw: bytes) -> list[int]:
        rank, none = self.ranks.get, len(self.bytes_of)
        parts = [raw[i : i + 1] for i in range(len(raw))]
        pairs = [rank(raw[i : i + 2], none) for i in range(len(raw) - 1)]
        while pairs and (least := min(pairs)) < none:
            i = pairs.index(least)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = rank(parts[i] + parts[i + 1], none)
            if i:
                pairs[i - 1] = rank(parts[i - 1] + parts[i], none)
        return [self.ranks[p] for p in parts]

    def fits(self, a: int, b: int) -> bool:
        """Whether two tokens side by side are the encoding of their bytes."""
        if (a, b) not in self.pairs:
            if len(self.pairs) >= REMEMBERED:
                self.pairs.clear()
            self.pairs[a, b] = self.merges(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
        return self.pairs[a, b]

    def tree(self, text: str, lo: int, hi: int) -> list[int]:
        """Ids of text[lo:hi]."""
        if hi - lo <= self.leaf_chars or not SAFE_CUT.search(text, lo, hi):
            return self.leaf(text[lo:hi])
        mid = (lo + hi) // 2
        return self.join(text, lo, mid, hi, self.tree(text, lo, mid), self.tree(text, mid, hi))

    def join(self, text: str, lo: int, mid: int, hi: int, left: list[int], right: list[int]) -> list[int]:
        """Ids of text[lo:hi] from those of text[lo:mid] and text[mid:hi]."""
        width = FIRST_WINDOW
        while True:
            a, b = max(lo, mid - width), min(hi, mid + width)
            # Both characters of a cut lie in the half whose encoding is kept.
            start = next(iter([m.start() for m in SAFE_CUT.finditer(text, a, mid)][-1:]), None)
            stop = m.start() if (m := SAFE_CUT.search(text, mid + 1, b)) else None
            start, stop = lo if start is None and a == lo else start, hi if stop is None and b == hi else stop
            if start is not None and stop is not None:
                keep = self.drop_bytes(left, len(text[start:mid].encode()), -1)
                skip = self.drop_bytes(right, len(text[mid:stop].encode()), 1)
                return left[:keep] + self.leaf(text[start:stop]) + right[skip:]
            width *= 2

    def drop_bytes(self, ids: list[int], n: int, step: int) -> int:
        """Where in ``ids`` the last (step -1) or the first (step 1) ``n`` bytes begin or end."""
        i = len(ids) if step < 0 else 0
        while n > 0:
            n -= len(self.bytes_of[ids[i - 1 if step < 0 else i]])
            i += step
        if n:
            raise ValueError("a safe cut does not lie between tokens: the pattern does not split there")
        return i

    def decode(self, ids: list[int]) -> bytes:
        """Concatenation up the tree of halves."""
        if len(ids) <= 4096:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])

    def digest(self, text: str) -> tuple[int, str, str]:
        """(n_tokens, sha256 of the ids, sha256 of the bytes decoded from them)."""
        ids = self.encode(text)
        line = " ".join(map(self.decimal.__getitem__, ids))
        return len(ids), hashlib.sha256(line.encode()).hexdigest(), hashlib.sha256(self.decode(ids)).hexdigest()


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """One per worker process."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec.load(path, pattern)
    return _codecs[path, pattern]


def encode_documents(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (and token_ids on demand) of each row.

    ``ranks_path`` lies where every executor has it (an installed package) or
    is the name of a file added to the session. Null text is the empty text: no
    tokens and the digests of nothing. Each row is a result of its own, so
    repeated rows and null ids pass through. Strictly per row: no shuffle.
    """
    docs = rows_of(df, id_col, text_col)
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", token_ids array<int>" * ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        c = codec(ranks_path if os.path.exists(ranks_path) else SparkFiles.get(ranks_path), pattern)
        for batch in batches:
            for lo, hi in cuts(batch, "text", 4 << 20):
                part = batch.slice(lo, hi - lo)
                texts = [t or "" for t in part.column("text").to_pylist()]
                got = [c.digest(t) for t in texts]
                cols = [part.column("doc_id"), pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.string()), pa.array([g[2] for g in got], pa.string())]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if ids:
                    cols.append(pa.array([c.encode(t) for t in texts], pa.list_(pa.int32())))
                    names.append("token_ids")
                yield pa.RecordBatch.from_arrays(cols, names)

    return docs.select("doc_id", F.col("text")).mapInArrow(run, schema)
