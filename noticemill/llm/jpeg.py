"""Baseline JPEG as a media column: lossless storage of bytes as coefficients, and a batch decoder in numpy.

A payload of 64-byte blocks is stored as one grey image: each byte minus 128 is a quantised coefficient of an 8x8 block, in
scan order, with a quantisation table of ones.  Baseline coding of coefficients is lossless, so the payload can be read back.

The decoder reads baseline images of one scan (several components, sampling factors, with or without restart intervals); images of
several scans are refused.  Restart
segments are independent, so it decodes the segments of many images side by side: step k decodes the k-th symbol of all of
them.  The writer restarts after each block for that reason.
"""

from __future__ import annotations

import functools
import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, with_ids

BLOCK = 64
#: Blocks that are coded or decoded side by side.
LANES = 1 << 14

# Marker codes of the format.
SOI, EOI, SOF0, DHT, DQT, DRI, SOS, COM, RST0 = 0xD8, 0xD9, 0xC0, 0xC4, 0xDB, 0xDD, 0xDA, 0xFE, 0xD0


@functools.lru_cache(maxsize=1)
def own_tables() -> tuple[bytes, bytes]:
    """The writer's code tables, as in a DHT segment: 16 counts by length, then symbols.

    DC: twelve categories of 4 bits.  AC: end of block and the ten categories without zeros before them have 4 bits, all other
    symbols 12 bits.
    """
    dc = bytes([0, 0, 0, 12] + [0] * 12) + bytes(range(12))
    short = [0x00, *range(1, 11)]
    long = [0xF0, *(run << 4 | size for run in range(1, 16) for size in range(1, 11))]
    ac = bytes([0, 0, 0, len(short)] + [0] * 7 + [len(long)] + [0] * 4) + bytes(short + long)
    return dc, ac


def codes(table: bytes) -> list[tuple[int, int, int]]:
    """(symbol, code, length) of each symbol of a DHT table, by the format's canonical rule."""
    out, code, at = [], 0, 16
    for length in range(1, 17):
        for _ in range(table[length - 1]):
            out.append((table[at], code, length))
            code, at = code + 1, at + 1
        code <<= 1
    return out


@functools.lru_cache(maxsize=32)
def lookup(table: bytes) -> np.ndarray:
    """length << 8 | symbol for each possible next 16 bits; 0 where no code fits."""
    full = np.zeros(1 << 16, dtype=np.int32)
    for symbol, code, length in codes(table):
        full[code << (16 - length) : (code + 1) << (16 - length)] = length << 8 | symbol
    return full


@functools.lru_cache(maxsize=4)
def by_symbol(table: bytes) -> tuple[np.ndarray, np.ndarray]:
    code, length = np.zeros(256, dtype=np.uint64), np.zeros(256, dtype=np.int64)
    for symbol, c, n in codes(table):
        code[symbol], length[symbol] = c, n
    return code, length


def code_blocks(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entropy-coded bytes of blocks (n, 64), each on its own and filled up with ones; and the bytes of each block."""
    n = len(values)
    dc, ac = own_tables()
    magnitude = np.abs(values).astype(np.int64)
    sizes = np.frexp(magnitude.astype(np.float32))[1].astype(np.int64)
    extra = np.where(values < 0, values + (1 << sizes) - 1, values).astype(np.uint64)
    bits = np.zeros((n, BLOCK + 2), dtype=np.int64)
    word = np.zeros((n, BLOCK + 2), dtype=np.uint64)
    code, length = by_symbol(dc)
    bits[:, 0] = length[sizes[:, 0]] + sizes[:, 0]
    word[:, 0] = code[sizes[:, 0]] << sizes[:, 0].astype(np.uint64) | extra[:, 0]
    code, length = by_symbol(ac)
    there = values[:, 1:] != 0
    k = np.arange(1, BLOCK)
    last = np.maximum.accumulate(np.where(there, k, 0), axis=1)
    run = k - np.concatenate([np.zeros((n, 1), dtype=np.int64), last[:, :-1]], axis=1) - 1
    symbol = np.where(there, (run & 15) << 4 | sizes[:, 1:], 0)
    bits[:, 1:BLOCK] = np.where(there, length[symbol] + sizes[:, 1:], 0)
    word[:, 1:BLOCK] = np.where(there, code[symbol] << sizes[:, 1:].astype(np.uint64) | extra[:, 1:], 0)
    for r, c in np.argwhere(there & (run > 15)):  # codes for sixteen zeros go before the symbol
        for _ in range(run[r, c] >> 4):
            word[r, c + 1] |= code[0xF0] << np.uint64(bits[r, c + 1])
            bits[r, c + 1] += length[0xF0]
    ends = last[:, -1] < BLOCK - 1
    bits[:, BLOCK] = np.where(ends, length[0], 0)
    word[:, BLOCK] = np.where(ends, code[0], 0)
    total = bits.sum(1)
    fill = -total % 8
    bits[:, BLOCK + 1], word[:, BLOCK + 1] = fill, (1 << fill) - 1
    size = (total + fill) >> 3
    start = np.cumsum(bits, axis=1) - bits + 8 * (np.cumsum(size) - size)[:, None]
    used = bits.ravel() > 0
    start, bits, word = start.ravel()[used], bits.ravel()[used], word.ravel()[used]
    width = (7 + int(bits.max(initial=0)) + 7) >> 3
    word <<= (8 * width - (start & 7) - bits).astype(np.uint64)
    out = np.zeros(int(size.sum()) + 8)
    for j in range(width):  # bits do not overlap, so that adding is joining
        part = (word >> np.uint64(8 * (width - 1 - j))) & np.uint64(255)
        out += np.bincount((start >> 3) + j, weights=part.astype(np.float64), minlength=len(out))
    return out[: int(size.sum())].astype(np.uint8), size


def scan_of(values: np.ndarray) -> bytes:
    """Scan data of one grey image with a restart after each block."""
    out, first = [], 0
    for at in range(0, len(values), LANES):
        data, size = code_blocks(values[at : at + LANES])
        full = data == 255
        block = np.repeat(np.arange(len(size)), size)
        steps = 1 + full
        place = np.cumsum(steps) - steps + 2 * block
        ends = np.cumsum(size + np.bincount(block[full], minlength=len(size)) + 2)
        buffer = np.zeros(int(ends[-1]), dtype=np.uint8)
        buffer[place] = data
        buffer[ends - 2] = 255
        buffer[ends - 1] = RST0 + (first + np.arange(len(size))) % 8
        out.append(buffer.tobytes())
        first += len(size)
    return b"".join(out)[:-2]


def segment(marker: int, body: bytes) -> bytes:
    return bytes([0xFF, marker]) + (len(body) + 2).to_bytes(2, "big") + body


def write(payload: bytes) -> bytes:
    """A grey baseline JPEG whose coefficients are the bytes of ``payload``, whose length is a positive multiple of 64."""
    values = np.frombuffer(payload, dtype=np.uint8).reshape(-1, BLOCK).astype(np.int64) - 128
    n = len(values)
    wide = int(np.ceil(np.sqrt(n)))
    high = -(-n // wide)
    values = np.concatenate([values, np.zeros((wide * high - n, BLOCK), dtype=np.int64)])
    dc, ac = own_tables()
    return b"".join(
        [
            bytes([0xFF, SOI]),
            segment(COM, b"payload %d" % len(payload)),
            segment(DQT, bytes([0]) + bytes([1] * BLOCK)),
            segment(SOF0, bytes([8]) + (8 * high).to_bytes(2, "big") + (8 * wide).to_bytes(2, "big") + bytes([1, 1, 0x11, 0])),
            segment(DHT, bytes([0x00]) + dc),
            segment(DHT, bytes([0x10]) + ac),
            segment(DRI, (1).to_bytes(2, "big")),
            segment(SOS, bytes([1, 1, 0x00, 0, 63, 0])),
            scan_of(values),
            bytes([0xFF, EOI]),
        ]
    )


@dataclass
class Image:
    width: int = 0
    height: int = 0
    parts: list[tuple[int, int, int, int]] = field(default_factory=list)  # component, h, v, quantisation table
    tables: dict[int, bytes] = field(default_factory=dict)
    quant: dict[int, np.ndarray] = field(default_factory=dict)
    restart: int = 0
    comment: bytes = b""
    chosen: dict[int, int] = field(default_factory=dict)
    scan: bytes = b""

    def grid(self) -> tuple[int, int]:
        """MCUs across and down."""
        if len(self.parts) == 1:
            return -(-self.width // 8), -(-self.height // 8)
        h, v = max(p[1] for p in self.parts), max(p[2] for p in self.parts)
        return -(-self.width // (8 * h)), -(-self.height // (8 * v))


def parse(data: bytes) -> Image:
    """Markers of a baseline image; raises ValueError for other kinds and for several scans."""
    if data[:2] != bytes([0xFF, SOI]):
        raise ValueError("not a JPEG")
    image, at = Image(), 2
    while True:
        if at + 4 > len(data) or data[at] != 0xFF:
            raise ValueError("broken JPEG")
        marker = data[at + 1]
        if marker == 0xFF:
            at += 1
            continue
        size = int.from_bytes(data[at + 2 : at + 4], "big")
        body = data[at + 4 : at + 2 + size]
        at += 2 + size
        if marker == SOF0:
            image.height, image.width = int.from_bytes(body[1:3], "big"), int.from_bytes(body[3:5], "big")
            for i in range(body[5]):
                c, hv, q = body[6 + 3 * i : 9 + 3 * i]
                image.parts.append((c, hv >> 4, hv & 15, q))
        elif 0xC0 < marker <= 0xCF and marker not in (DHT, 0xC8, 0xCC):
            raise ValueError("not a baseline JPEG")
        elif marker == DHT:
            while body:
                n = 17 + sum(body[1:17])
                image.tables[body[0]] = body[1:n]
                body = body[n:]
        elif marker == DQT:
            while body:
                deep = body[0] >> 4
                n = 1 + BLOCK * (1 + deep)
                image.quant[body[0] & 15] = np.frombuffer(body[1:n], dtype=">u2" if deep else "u1").astype(np.int64)
                body = body[n:]
        elif marker == DRI:
            image.restart = int.from_bytes(body, "big")
        elif marker == COM:
            image.comment = body
        elif marker == SOS:
            image.chosen = {body[1 + 2 * i]: body[2 + 2 * i] for i in range(body[0])}
            if image.chosen.keys() != {c for c, *_ in image.parts}:
                raise ValueError("an image of several scans")
            end = data.rfind(bytes([0xFF, EOI]))
            image.scan = data[at : end if end >= at else len(data)]
            return image


def _lanes(scan: np.ndarray, at: np.ndarray, count: np.ndarray, order: list, tables: dict, parts: int) -> list[np.ndarray]:
    """Coefficients of segments that start at bytes ``at`` of an unstuffed ``scan`` and hold ``count`` MCUs each.

    ``order`` names (component, DC table, AC table) of each block of an MCU.  Returns (MCU, block, 64) flattened by lane.
    """
    wide = np.zeros(len(scan) + 1, dtype=np.uint64)
    padded = np.concatenate([scan, np.full(16, 255, dtype=np.uint8)])
    for j in range(8):
        wide[:] = (wide << np.uint64(8)) | padded[j : j + len(wide)]
    pos = at.astype(np.int64) * 8
    first = np.cumsum(count) - count
    out = np.zeros((int(count.sum()), len(order), BLOCK), dtype=np.int16)
    before = np.zeros((len(at), parts), dtype=np.int64)

    def symbol(lane: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = pos[lane]
        left = wide[np.minimum(p >> 3, len(scan))] << (p & 7).astype(np.uint64)
        hit = table[(left >> np.uint64(48)).astype(np.int64)]
        if not hit.all():
            raise ValueError("broken scan")
        length, symbol = hit >> 8, hit & 255
        size = symbol & 15
        raw = ((left << length.astype(np.uint64)) >> np.uint64(1) >> (63 - size).astype(np.uint64)).astype(np.int64)
        value = np.where((raw >> np.maximum(size - 1, 0)) & 1, raw, raw - (1 << size) + 1)
        pos[lane] = p + length + size
        return symbol, np.where(size > 0, value, 0)

    for mcu in range(int(count.max(initial=0))):
        lane = np.flatnonzero(count > mcu)
        for block, (part, dc, ac) in enumerate(order):
            row = first[lane] + mcu
            _, step = symbol(lane, tables[dc])
            before[lane, part] += step
            out[row, block, 0] = before[lane, part]
            live, row, k = lane, row, np.ones(len(lane), dtype=np.int64)
            while len(live):
                sym, value = symbol(live, tables[ac])
                size = sym & 15
                k += np.where(size > 0, sym >> 4, 0)
                given = (size > 0) & (k < BLOCK)
                if given.all():
                    out[row, block, k] = value
                else:
                    out[row[given], block, k[given]] = value[given]
                k = np.where(size > 0, k + 1, np.where(sym == 0xF0, k + 16, BLOCK))
                more = k < BLOCK
                if not more.all():
                    live, row, k = live[more], row[more], k[more]
    return out


def decode(images: list[Image]) -> list[np.ndarray]:
    """Quantised coefficients of each image's MCUs: (MCUs, blocks, 64); images with equal tables are decoded together."""
    alike: dict[tuple, list[int]] = {}
    for i, image in enumerate(images):
        key = (tuple(image.parts), tuple(sorted(image.tables.items())), tuple(image.chosen.items()))
        alike.setdefault(key, []).append(i)
    out: list[np.ndarray] = [np.empty(0)] * len(images)
    for own in alike.values():
        image = images[own[0]]
        single = len(image.parts) == 1
        order = []
        for part, (c, h, v, _) in enumerate(image.parts):
            order += [(part, image.chosen[c] >> 4, 0x10 | image.chosen[c] & 15)] * (1 if single else h * v)
        tables = {k: lookup(t) for k, t in image.tables.items()}
        scan = np.frombuffer(b"".join(b"\0" + images[i].scan for i in own), dtype=np.uint8)
        starts = np.cumsum([0] + [1 + len(images[i].scan) for i in own])[:-1]
        after = np.concatenate([[False], scan[:-1] == 255])
        after[starts] = False
        after[starts + 1] = False
        reset = after & (scan >= RST0) & (scan < RST0 + 8)
        keep = ~(after & (scan == 0)) & ~reset
        keep[:-1] &= ~reset[1:]
        keep[starts] = False
        where = np.cumsum(keep) - keep
        marks = np.flatnonzero(reset)
        owner = np.searchsorted(starts, marks, side="right") - 1
        at = np.concatenate([starts, marks])
        whose = np.concatenate([np.arange(len(own)), owner])
        ranked = np.argsort(at, kind="stable")
        at, whose = where[at[ranked]], whose[ranked]
        mcus = np.array([np.prod(images[i].grid()) for i in own])
        each = np.array([images[i].restart or n for i, n in zip(own, mcus, strict=True)])
        nth = np.arange(len(at)) - np.searchsorted(whose, whose)
        count = np.minimum(each[whose], mcus[whose] - nth * each[whose])
        clean = scan[keep]
        if (count <= 0).any() or not np.array_equal(np.bincount(whose, weights=count, minlength=len(own)).astype(np.int64), mcus):
            raise ValueError("broken scan")
        found = []
        for a in range(0, len(at), LANES):
            low, high = int(at[a]), int(at[a + LANES]) if a + LANES < len(at) else len(clean)
            found.append(_lanes(clean[low:high], at[a : a + LANES] - low, count[a : a + LANES], order, tables, len(image.parts)))
        for i, part in zip(own, np.split(np.concatenate(found), np.cumsum(mcus)[:-1]), strict=True):
            out[i] = part
    return out


def thumbnail(image: Image, coefficients: np.ndarray) -> np.ndarray:
    """Luminance of each 8x8 block from its DC coefficient alone."""
    across, down = image.grid()
    _, h, v, q = image.parts[0]
    h, v = (1, 1) if len(image.parts) == 1 else (h, v)
    dc = coefficients[:, : h * v, 0].astype(np.int64) * int(image.quant[q][0])
    grey = np.clip((dc + 4) // 8 + 128, 0, 255).astype(np.uint8)
    return grey.reshape(down, across, v, h).transpose(0, 2, 1, 3).reshape(down * v, across * h)


def thumbnail_hash(grey: np.ndarray) -> int:
    """64 bits: whether each of 8x8 cells is lighter than the mean of all cells; every cell averages the pixels it covers."""
    ys, xs = (np.arange(9) * n / 8 for n in grey.shape)
    y0, y1 = np.floor(ys[:-1]).astype(int), np.maximum(np.ceil(ys[1:]).astype(int), 1)
    x0, x1 = np.floor(xs[:-1]).astype(int), np.maximum(np.ceil(xs[1:]).astype(int), 1)
    sums = np.zeros((grey.shape[0] + 1, grey.shape[1] + 1), dtype=np.int64)
    sums[1:, 1:] = grey.astype(np.int64).cumsum(0).cumsum(1)
    box = sums[np.ix_(y1, x1)] - sums[np.ix_(y0, x1)] - sums[np.ix_(y1, x0)] + sums[np.ix_(y0, x0)]
    cells = box / np.outer(y1 - y0, x1 - x0)
    return int.from_bytes(np.packbits((cells > cells.mean()).ravel()).tobytes(), "big")


def feature_of(image: Image, coefficients: np.ndarray) -> str:
    grey = thumbnail(image, coefficients)
    return f"{image.width}x{image.height}:{thumbnail_hash(grey):016x}:{zlib.crc32(grey.tobytes()):08x}"


def payload_of(image: Image, coefficients: np.ndarray) -> bytes:
    size = int(image.comment.split()[1])
    return (coefficients.reshape(-1)[:size] + 128).astype(np.uint8).tobytes()


def _groups(payloads: list[bytes], most: int = LANES * BLOCK) -> Iterator[list[bytes]]:
    group, size = [], 0
    for p in payloads:
        if group and size + len(p) > most:
            yield group
            group, size = [], 0
        group.append(p)
        size += len(p)
    if group:
        yield group


def store_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_media: bool = False) -> DataFrame:
    """Store each whole text as a JPEG, read it back and describe it; one row for each row of ``docs``, no shuffle.

    Whole texts are stored, of any length.  Null texts count as empty, and an empty text is stored as one block of zeros.  Equal texts give equal values.  Repeated
    rows give repeated results, an empty table an empty one; other columns are not read.  ``feature`` is width x height, the
    64-bit hash of the DC-only thumbnail, and the thumbnail's crc32.  With ``keep_media`` the stored bytes come along.
    """
    long, text = pa.int64(), pa.string()
    made = [("n_bytes", long), ("payload_bytes", long), ("payload_sha256", text), ("tail_crc32", long), ("media_bytes", long), ("media_sha256", text), ("feature", text)]
    kinds = pa.schema([*made, *[("media", pa.binary())] * keep_media])

    def described(pdf: pd.DataFrame) -> tuple[None, pd.DataFrame]:
        raw = [(t or "").encode() for t in pdf["text"]]
        rows = []
        for group in _groups([r + bytes(-len(r) % BLOCK or BLOCK * (not r)) for r in raw]):
            media = [write(p) for p in group]
            images = [parse(m) for m in media]
            for m, image, coefficients in zip(media, images, decode(images), strict=True):
                p = payload_of(image, coefficients)
                row = (len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-BLOCK:]), len(m), hashlib.sha256(m).hexdigest())
                rows.append((*row, feature_of(image, coefficients), *[m] * keep_media))
        out = pd.DataFrame(rows, columns=kinds.names[1:])
        out.insert(0, "n_bytes", [len(r) for r in raw])
        return None, out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return with_ids(batches, described, ["doc_id"], kinds)

    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return rows.mapInArrow(run, schema + ", media binary" * keep_media)
