"""Main text of web pages by a linear-chain conditional random field over leaf blocks.

Blocks (``dom``) are tagged main or not from the elements they stand in, what
these are named, and their text, and by their neighbours; Viterbi decodes whole
pages. The field is trained on ``PAGES`` labelled pages that ``pages`` builds.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import dom, pages
from millrace.llm.common import CHUNK_BYTES, cuts

#: Labelled pages to learn from, passes over them, step and decay of the weights.
PAGES, EPOCHS, RATE, DECAY = 1200, 80, 0.5, 1e-5
#: Names of features are hashed to so many weights.
WEIGHTS = 1 << 13
#: Words that pages say about themselves.
TELLING = frozenset("cookie cookies privacy policy subscribe newsletter comment comments reply share copyright rights reserved advertisement sponsored login sign menu home search related read more terms contact about".split())
OTHER, MAIN = 0, 1


@lru_cache(maxsize=1 << 16)
def weight_place(name: str) -> int:
    return zlib.crc32(name.encode()) % WEIGHTS


def step(x: float, *bounds: float) -> int:
    return sum(x >= b for b in bounds)


def features(page: dom.Page) -> list[list[int]]:
    """Places of each block's weights."""
    out, n = [], len(page.blocks)
    title = page.title.lower()
    for i, b in enumerate(page.blocks):
        size, low = len(b.text), b.text[:400].lower()
        words = low.split()
        names = ["", f"t{b.tag}", *b.around, *(f"n{x}" for x in b.within), f"b{b.path}", f"b{b.path}>{b.tag}"]
        names += [f"l{step(size, 8, 25, 60, 120, 300)}", f"k{step(b.link_chars / size, 0.01, 0.3, 0.7, 0.95)}", f"e{b.text[-1] in '.!?:;'}", f"p{step(i / n, 0.1, 0.3, 0.6, 0.85)}"]
        names += [f"c{step(b.text.count(',') / (1 + size), 0.002, 0.02)}", f"d{step(sum(c.isdigit() for c in low) / len(low), 0.01, 0.2)}", f"h{b.tag}{size > 80}"]
        if len(low) > 3 and title.startswith(low[:60]):
            names.append("title")
        if "©" in b.text:
            names.append("©")
        names += [f"w{w}" for w in {w.strip(".,!?") for w in words[:40]} & TELLING]
        out.append([weight_place(x) for x in names])
    return out


@dataclass
class Field:
    weights: np.ndarray  # (WEIGHTS, 2)
    moves: np.ndarray  # (2, 2) from, to

    def emissions(self, feats: list[list[int]]) -> np.ndarray:
        if not feats:
            return np.zeros((0, 2))
        first = np.cumsum([0, *map(len, feats[:-1])])
        return np.add.reduceat(self.weights[np.concatenate(feats)], first, axis=0)

    def tags(self, emit: np.ndarray) -> list[int]:
        """Viterbi over the blocks of one page; of equal paths the one with less main text."""
        (oo, om), (mo, mm) = self.moves.tolist()
        o, m, back = 0.0, 0.0, []
        for k, (eo, em) in enumerate(emit.tolist()):
            if k:
                from_o, from_m = (o + oo < m + mo, o + om < m + mm)
                back.append((from_o, from_m))
                o, m = (m + mo if from_o else o + oo), (m + mm if from_m else o + om)
            o, m = o + eo, m + em
        if not len(emit):
            return []
        out = [int(m > o)]
        for b in reversed(back):
            out.append(int(b[out[-1]]))
        return out[::-1]


def fit(sequences: list[tuple[list[list[int]], np.ndarray]]) -> Field:
    """Maximum likelihood with AdaGrad, forward and backward sums over all pages at once; without a block all weights are 0."""
    field = Field(np.zeros((WEIGHTS, 2)), np.zeros((2, 2)))
    sequences = [s for s in sequences if len(s[1])]
    if not sequences:
        return field
    size = np.array([len(t) for _, t in sequences])
    n, longest = len(size), int(size.max())
    flat = np.concatenate([np.concatenate(f) for f, _ in sequences])
    lengths = np.concatenate([[len(x) for x in f] for f, _ in sequences])
    owner, first = np.repeat(np.arange(len(lengths)), lengths), np.cumsum(lengths) - lengths
    live = np.arange(longest)[None, :] < size[:, None]
    tags = np.zeros((n, longest), np.int64)
    tags[live] = np.concatenate([t for _, t in sequences])
    truth = np.eye(2)[tags] * live[..., None]
    seen = np.einsum("nta,ntb->ab", truth[:, :-1], truth[:, 1:])
    sums = [np.zeros_like(field.weights), np.zeros((2, 2))]
    for _ in range(EPOCHS):
        emit = np.zeros((n, longest, 2))
        emit[live] = np.add.reduceat(field.weights[flat], first, axis=0)
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
        error = (truth - belief)[live][owner]
        grad = np.stack([np.bincount(flat, weights=error[:, k], minlength=WEIGHTS) for k in range(2)], axis=1)
        for x, g, s in ((field.weights, grad / n - DECAY * field.weights, sums[0]), (field.moves, (seen - moved) / n - DECAY * field.moves, sums[1])):
            s += g * g
            x += RATE * g / np.sqrt(s + 1e-8)
    return field


def labelled(page: str) -> tuple[dom.Page, np.ndarray]:
    """A labelled page without its marks, and the tags of its blocks."""
    read = dom.read(page)
    tags = np.array([pages.MARK in b.text for b in read.blocks], np.int64)
    for b in read.blocks:
        b.text = b.text.replace(pages.MARK, "") or "."
    return read, tags


@lru_cache(maxsize=4)
def train(n: int = PAGES) -> Field:
    """The field that the first ``n`` labelled pages teach; the same one every time."""
    return fit([(features(read), tags) for read, tags in (labelled(pages.labelled_page(k)) for k in range(n))])


def main_text(page: str, field: Field) -> str:
    read = dom.read(page)
    tags = field.tags(field.emissions(features(read)))
    return " ".join(b.text for b, t in zip(read.blocks, tags, strict=True) if t == MAIN)


def extract(df: DataFrame, field: Field | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of each row.

    A null or empty page, and one without a main block, has an empty text. Rows
    stand alone: repeated rows, null ids and null urls pass, and an empty table
    stays empty. A page is read whole, however long; markup that is cut off or
    never closed ends with the page. Character references that name no
    character become U+FFFD. Other columns may have any names.
    """
    field = field or train()
    rows = df.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"), F.col(f"`{html_col}`").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in cuts(batch, "html", CHUNK_BYTES):
                part = batch.slice(lo, hi - lo)
                texts = [main_text(x or "", field) for x in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("page_id", "url"))
    return rows.mapInArrow(run, f"{kinds}, text string, n_chars long")
