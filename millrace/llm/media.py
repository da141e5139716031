"""Media columns: byte payloads as progressive JPEG files, and their RGB tensors.

A payload is held losslessly in the file's own unit, the quantised DCT
coefficient: byte b of a block is the coefficient with sign and magnitude bits
b. The file is an ordinary progressive one (4:2:0, all quantisers 1): first
scans by component and spectral band at reduced precision, then refinement
scans for the last bit. The decoder accumulates the scans into coefficient
arrays, inverse-transforms them, upsamples chroma and yields RGB.

Every coefficient that the encoder writes has the same category, so each
entropy-coded scan is a fixed-width bit field and moves as whole numpy arrays.
The decoder takes that way only where a scan's Huffman table holds a single
one-bit code; any other scan goes through the bit-by-bit decoder.
"""

from __future__ import annotations

import hashlib
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.common import map_texts, rows_of

#: Blocks of Y, Cb, Cr in a unit of 16 x 16 pixels.
UNIT = (4, 1, 1)
#: Spectral bands of the first AC scans.
BANDS = ((1, 5), (6, 63))
MAX_SIDE_UNITS = 4095

# Zigzag order (ITU-T T.81, figure A.6), from its rule: diagonals, alternately up and down.
ZIGZAG = np.array([i * 8 + j for i, j in sorted(((i, j) for i in range(8) for j in range(8)), key=lambda x: (x[0] + x[1], x[0] if (x[0] + x[1]) % 2 else x[1]))])
_K = np.arange(8)
#: COSINES[x, u]: value at x of the orthonormal basis function u.
COSINES = (np.cos((2 * _K[:, None] + 1) * _K[None, :] * np.pi / 16) * np.where(_K == 0, np.sqrt(1 / 8), 0.5)).astype(np.float32)


class MediaError(ValueError):
    """The bytes are not a progressive JPEG that this decoder reads."""


def segment(marker: int, body: bytes) -> bytes:
    return bytes((0xFF, marker)) + (len(body) + 2).to_bytes(2, "big") + body


def one_code(kind: int, symbol: int) -> bytes:
    """A Huffman table whose only code is the bit 0."""
    return bytes((kind, 1, *[0] * 15, symbol))


def stuffed(data: np.ndarray) -> bytes:
    return data.tobytes().replace(b"\xff", b"\xff\x00")


def scan(component: int, tables: int, start: int, stop: int, high: int, low: int) -> bytes:
    return segment(0xDA, bytes((1, component, tables, start, stop, high << 4 | low)))


TABLES = segment(0xC4, one_code(0x00, 7)) + segment(0xC4, one_code(0x10, 0x07)) + segment(0xC4, one_code(0x11, 0x00))
QUANTISERS = segment(0xDB, bytes((0, *[1] * 64)))
RESTART_EACH, RESTART_NEVER = segment(0xDD, b"\x00\x01"), segment(0xDD, b"\x00\x00")


def pad(data: bytes) -> bytes:
    """Zero bytes up to a positive multiple of 64."""
    return data + bytes(-len(data) % 64 if data else 64)


def encode(payload: bytes) -> bytes:
    """A progressive JPEG that holds ``payload``, of a positive multiple of 64 bytes."""
    units = -(-len(payload) // 384)
    wide = -(-units // MAX_SIDE_UNITS)
    high = -(-units // wide)
    blocks = np.zeros((high, wide, 6, 64), np.uint8)
    blocks.reshape(-1)[: len(payload)] = np.frombuffer(payload, np.uint8)
    planes = (blocks[:, :, :4].reshape(high, wide, 2, 2, 64).transpose(0, 2, 1, 3, 4).reshape(-1, 64), blocks[:, :, 4].reshape(-1, 64), blocks[:, :, 5].reshape(-1, 64))
    frame = bytes((8,)) + (16 * high).to_bytes(2, "big") + (16 * wide).to_bytes(2, "big") + bytes((3, 1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0))
    out = [b"\xff\xd8", segment(0xFE, b"payload=%d" % len(payload)), QUANTISERS, segment(0xC2, frame), TABLES, RESTART_EACH]
    for c, plane in enumerate(planes, 1):
        dc = np.empty((len(plane), 3), np.uint8)
        dc[:, 0], dc[:, 1], dc[:, 2] = plane[:, 0] >> 1, 0xFF, 0xD0 + (np.arange(len(plane)) & 7)
        out += [scan(c, 0x00, 0, 0, 0, 1), dc.tobytes()[:-2]]
    out.append(RESTART_NEVER)
    for start, stop in BANDS:
        for c, plane in enumerate(planes, 1):
            out += [scan(c, 0x00, start, stop, 0, 1), (plane[:, start : stop + 1] >> 1).tobytes()]
    for c, plane in enumerate(planes, 1):
        bits = plane & 1
        bits[:, 1:] ^= plane[:, 1:] < 128  # magnitude bits: those of negative values count downwards
        last = np.packbits(bits[:, 0])
        if len(bits) % 8:
            last[-1] |= (1 << (8 - len(bits) % 8)) - 1
        bits[:, 0] = 0  # the code: end of band, correction bits follow
        out += [scan(c, 0x01, 1, 63, 1, 0), stuffed(np.packbits(bits, axis=1)), scan(c, 0x00, 0, 0, 1, 0), stuffed(last)]
    return b"".join([*out, b"\xff\xd9"])


@dataclass
class Frame:
    width: int = 0
    height: int = 0
    ids: list[int] = field(default_factory=list)
    sampling: list[tuple[int, int]] = field(default_factory=list)
    quantiser: list[int] = field(default_factory=list)
    planes: list[np.ndarray] = field(default_factory=list)  # (rows, columns, 64) of blocks, zigzag order
    extent: list[tuple[int, int]] = field(default_factory=list)  # rows, columns of blocks that own scans cover
    quantisers: dict[int, np.ndarray] = field(default_factory=dict)
    note: bytes = b""


class Bits:
    """Bits of one restart interval; beyond its end, ones."""

    def __init__(self, data: bytes):
        self.bits = np.unpackbits(np.frombuffer(data.replace(b"\xff\x00", b"\xff"), np.uint8)).tolist()
        self.at = 0

    def one(self) -> int:
        b = self.bits[self.at] if self.at < len(self.bits) else 1
        self.at += 1
        return b

    def take(self, n: int) -> int:
        x = 0
        for _ in range(n):
            x = x << 1 | self.one()
        return x

    def symbol(self, codes: dict[tuple[int, int], int]) -> int:
        code = 0
        for n in range(1, 17):
            code = code << 1 | self.one()
            if (n, code) in codes:
                return codes[n, code]
        raise MediaError("no such code")

    def signed(self, n: int) -> int:
        x = self.take(n)
        return x if not n or x >> (n - 1) else x - (1 << n) + 1


def codes_of(counts: bytes, symbols: bytes) -> dict[tuple[int, int], int]:
    codes, code, k = {}, 0, 0
    for n, count in enumerate(counts, 1):
        for _ in range(count):
            codes[n, code] = symbols[k]
            code, k = code + 1, k + 1
        code <<= 1
    return codes


def decode(data: bytes, fast: bool = True) -> Frame:
    """Accumulate all scans of a progressive JPEG into coefficient arrays."""
    raw = np.frombuffer(data, np.uint8)
    ff = np.flatnonzero(raw[:-1] == 0xFF)
    after = raw[ff + 1]
    ends = ff[(after != 0) & ~((after >= 0xD0) & (after <= 0xD7))]
    frame, tables, interval, at = Frame(), {}, 0, 2
    if data[:2] != b"\xff\xd8":
        raise MediaError("no start of image")
    while True:
        if at + 2 > len(data) or data[at] != 0xFF:
            raise MediaError("marker expected")
        marker = data[at + 1]
        if marker == 0xD9:
            return frame
        length = int.from_bytes(data[at + 2 : at + 4], "big")
        body, at = data[at + 4 : at + 2 + length], at + 2 + length
        if marker == 0xC2:
            open_frame(frame, body)
        elif marker == 0xDB:
            k = 0
            while k < len(body):
                wide = body[k] >> 4
                frame.quantisers[body[k] & 15] = np.frombuffer(body[k + 1 : k + 1 + 64 * (1 + wide)], ">u2" if wide else np.uint8).astype(np.float32)
                k += 1 + 64 * (1 + wide)
        elif marker == 0xC4:
            k = 0
            while k < len(body):
                n = sum(body[k + 1 : k + 17])
                tables[body[k]] = codes_of(body[k + 1 : k + 17], body[k + 17 : k + 17 + n])
                k += 17 + n
        elif marker == 0xDD:
            interval = int.from_bytes(body, "big")
        elif marker == 0xFE:
            frame.note = body
        elif marker == 0xDA:
            if (i := np.searchsorted(ends, at)) == len(ends):
                raise MediaError("scan without end")
            stop = int(ends[i])
            n = body[0]
            parts = [(frame.ids.index(body[1 + 2 * i]), body[2 + 2 * i] >> 4, body[2 + 2 * i] & 15) for i in range(n)]
            band = (body[1 + 2 * n], body[2 + 2 * n], body[3 + 2 * n] >> 4, body[3 + 2 * n] & 15)
            if not (fast and n == 1 and fixed_scan(frame, parts[0], band, tables, interval, data[at:stop])):
                any_scan(frame, parts, band, tables, interval, data[at:stop])
            at = stop
        elif 0xC0 <= marker <= 0xCF:
            raise MediaError("not progressive")


def open_frame(frame: Frame, body: bytes) -> None:
    frame.height, frame.width = int.from_bytes(body[1:3], "big"), int.from_bytes(body[3:5], "big")
    for i in range(body[5]):
        c, hv, q = body[6 + 3 * i : 9 + 3 * i]
        frame.ids.append(c)
        frame.sampling.append((hv >> 4, hv & 15))
        frame.quantiser.append(q)
    hm, vm = max(h for h, _ in frame.sampling), max(v for _, v in frame.sampling)
    wide, high = -(-frame.width // (8 * hm)), -(-frame.height // (8 * vm))
    for h, v in frame.sampling:
        frame.planes.append(np.zeros((high * v, wide * h, 64), np.int16))
        frame.extent.append((-(-frame.height * v // (8 * vm)), -(-frame.width * h // (8 * hm))))


def fixed_scan(frame: Frame, part: tuple, band: tuple, tables: dict, interval: int, data: bytes) -> bool:
    """A scan of one component with fixed-width fields, in whole arrays; False if it isn't one."""
    (c, dc, ac), (start, stop, high, low) = part, band
    plane = frame.planes[c]
    if frame.extent[c] != plane.shape[:2]:
        return False
    rows = plane.reshape(-1, 64)
    n = len(rows)
    if start == 0 and high == 0:
        if tables.get(dc) != {(1, 0): 7} or interval != 1 or len(data) != 3 * n - 2:
            return False
        x = np.frombuffer(data + b"\xff\xd0", np.uint8).reshape(n, 3)[:, 0].astype(np.int16)
        rows[:, 0] = (x - np.where(x < 64, 127, 0)) << low
        return not (x > 127).any()
    if interval:
        return False
    if start == 0:
        bits = np.unpackbits(np.frombuffer(data.replace(b"\xff\x00", b"\xff"), np.uint8))
        if len(bits) < n:
            return False
        rows[:, 0] |= bits[:n].astype(np.int16) << low
        return True
    table = tables.get(0x10 | ac)
    if high == 0:
        x = np.frombuffer(data, np.uint8)
        if table != {(1, 0): 0x07} or len(x) != n * (stop - start + 1) or (x > 127).any():
            return False
        x = x.reshape(n, -1).astype(np.int16)
        rows[:, start : stop + 1] = (x - 127 * (x < 64)) << low
        return True
    x = np.frombuffer(data.replace(b"\xff\x00", b"\xff"), np.uint8)
    if table != {(1, 0): 0x00} or stop - start != 62 or len(x) != 8 * n:
        return False
    bits, old = np.unpackbits(x.reshape(n, 8), axis=1), rows[:, start : stop + 1]
    if bits[:, 0].any() or not old.all():
        return False
    rows[:, start : stop + 1] = old + ((np.sign(old) * bits[:, 1:]) << low)
    return True


def any_scan(frame: Frame, parts: list, band: tuple, tables: dict, interval: int, data: bytes) -> None:
    """A scan bit by bit (ITU-T T.81, annexes F and G)."""
    start, stop, high, low = band
    if len(parts) == 1:
        c, dc, ac = parts[0]
        rows, columns = frame.extent[c]
        units = [[(c, dc, ac, i, j)] for i in range(rows) for j in range(columns)]
    else:
        h0, v0 = frame.sampling[0]
        rows, columns = frame.planes[0].shape[0] // v0, frame.planes[0].shape[1] // h0
        units = [
            [(c, dc, ac, i * frame.sampling[c][1] + y, j * frame.sampling[c][0] + x) for c, dc, ac in parts for y in range(frame.sampling[c][1]) for x in range(frame.sampling[c][0])]
            for i in range(rows)
            for j in range(columns)
        ]
    pieces, lo, k = [], 0, 0
    while (k := data.find(b"\xff", k)) >= 0:
        if k + 1 < len(data) and 0xD0 <= data[k + 1] <= 0xD7:
            pieces.append(data[lo:k])
            lo = k + 2
        k += 2
    pieces.append(data[lo:])
    for p, piece in enumerate(pieces):
        bits, last, run = Bits(piece), dict.fromkeys(range(len(frame.ids)), 0), 0
        for unit in units[p * interval : (p + 1) * interval] if interval else units:
            for c, dc, ac, i, j in unit:
                block = frame.planes[c][i, j]
                if start == 0:
                    if high:
                        block[0] |= bits.one() << low
                    else:
                        last[c] += bits.signed(bits.symbol(tables[dc]))
                        block[0] = last[c] << low
                elif high:
                    run = refine(block, bits, tables[0x10 | ac], start, stop, low, run)
                else:
                    run = first(block, bits, tables[0x10 | ac], start, stop, low, run)


def first(block: np.ndarray, bits: Bits, codes: dict, start: int, stop: int, low: int, run: int) -> int:
    if run:
        return run - 1
    k = start
    while k <= stop:
        zeros, size = divmod(bits.symbol(codes), 16)
        if size:
            k += zeros
            block[k] = bits.signed(size) * (1 << low)
        elif zeros == 15:
            k += 15
        else:
            return (1 << zeros) + bits.take(zeros) - 1
        k += 1
    return 0


def refine(block: np.ndarray, bits: Bits, codes: dict, start: int, stop: int, low: int, run: int) -> int:
    def correct(k: int) -> None:
        if bits.one():
            block[k] += (1 << low) if block[k] > 0 else -(1 << low)

    k = start
    while k <= stop and not run:
        zeros, size = divmod(bits.symbol(codes), 16)
        new = 0
        if size:
            new = (1 << low) if bits.one() else -(1 << low)
        elif zeros < 15:
            run = (1 << zeros) + bits.take(zeros)
            break
        while k <= stop:
            if block[k]:
                correct(k)
            elif zeros == 0:
                if new:
                    block[k] = new
                k += 1
                break
            else:
                zeros -= 1
            k += 1
    if run:
        for k in range(k, stop + 1):
            if block[k]:
                correct(k)
        run -= 1
    return run


def payload_of(frame: Frame) -> bytes:
    """The payload of a file of ``encode``, from its coefficients."""
    y, cb, cr = frame.planes
    high, wide = cb.shape[:2]
    blocks = np.empty((high, wide, 6, 64), np.int16)
    blocks[:, :, :4] = y.reshape(high, 2, wide, 2, 64).transpose(0, 2, 1, 3, 4).reshape(high, wide, 4, 64)
    blocks[:, :, 4], blocks[:, :, 5] = cb, cr
    negative = blocks < 0
    blocks[..., 0] += 254 * negative[..., 0]
    blocks[..., 1:] += 255 * negative[..., 1:]
    return blocks.astype(np.uint8).reshape(-1)[: int(frame.note.removeprefix(b"payload="))].tobytes()


def samples(frame: Frame, c: int) -> np.ndarray:
    """One component in space, before the level shift is undone."""
    plane = frame.planes[c]
    rows, columns = plane.shape[:2]
    x = np.empty((rows * columns, 64), np.float32)
    x[:, ZIGZAG] = plane.reshape(-1, 64) * frame.quantisers[frame.quantiser[c]]
    x = x.reshape(-1, 8) @ COSINES.T
    x = x.reshape(-1, 8, 8).transpose(0, 2, 1).reshape(-1, 8) @ COSINES.T
    return x.reshape(rows, columns, 8, 8).transpose(0, 3, 1, 2).reshape(rows * 8, columns * 8)


def rgb(frame: Frame) -> np.ndarray:
    """(height, width, 3) of uint8: inverse transform, chroma at full resolution, JFIF colours."""
    hm, vm = max(h for h, _ in frame.sampling), max(v for _, v in frame.sampling)
    full = []
    for c, (h, v) in enumerate(frame.sampling):
        x = samples(frame, c)
        if (h, v) != (hm, vm):
            x = np.repeat(np.repeat(x, vm // v, axis=0), hm // h, axis=1)
        full.append(x[: frame.height, : frame.width])
    if len(full) == 1:
        full = [full[0], np.zeros_like(full[0]), np.zeros_like(full[0])]
    y, cb, cr = full
    y = y + 128.5
    out = np.empty((*y.shape, 3), np.uint8)
    out[..., 0] = np.clip(y + 1.402 * cr, 0, 255)
    out[..., 1] = np.clip(y - 0.344136 * cb - 0.714136 * cr, 0, 255)
    out[..., 2] = np.clip(y + 1.772 * cb, 0, 255)
    return out


def feature(tensor: np.ndarray) -> str:
    """Height x width, the mean of each channel, and quarters of the green histogram in 1/1000."""
    n = tensor.shape[0] * tensor.shape[1]
    means = tensor.reshape(-1, 3).sum(axis=0, dtype=np.int64) * 100 // n
    hist = np.bincount(tensor[..., 1].reshape(-1) >> 6, minlength=4) * 1000 // n
    return f"{tensor.shape[0]}x{tensor.shape[1]} " + ",".join(map(str, means)) + " " + ",".join(map(str, hist))


def media_column(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: bool = False) -> DataFrame:
    """doc_id, digests of payload and stored form, feature, the RGB tensor and its shape; with ``keep`` also the media.

    Null text is the empty payload, 64 zero bytes. The length of a text is
    bounded only by a JPEG's sides (6 GB). Every row by itself: repeated rows,
    null ids and empty tables need no special case.
    """
    docs = rows_of(df, id_col, text_col)
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, tensor binary, tensor_shape array<int>"
    if keep:
        schema += ", media binary"

    def run(texts: list[bytes], cols: dict[str, pa.Array]) -> dict[str, object]:
        out: dict[str, list] = {k: [] for k in ("n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "tensor", "tensor_shape", "media")}
        for text in texts:
            media = encode(pad(text))
            frame = decode(media)
            back, tensor = payload_of(frame), rgb(frame)
            row = (len(text), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-64:]), len(media), hashlib.sha256(media).hexdigest(), feature(tensor), tensor.tobytes(), list(tensor.shape))
            for k, v in zip(out, row, strict=False):
                out[k].append(v)
            if keep:
                out["media"].append(media)
        return {"doc_id": cols["doc_id"], **out}

    return map_texts(docs, schema, run)
