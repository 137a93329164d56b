"""Media columns in FLAC: mono streams of 192-sample frames, written and read for many documents at a time.

Writing takes, for each frame, the cheapest of a constant, a verbatim, a fixed linear predictor (order 0 to 4) or one fitted to the
frame (order LPC, by the autocorrelation of its samples), the predictors with Rice coded residuals. Reading finds the frames by their checked headers, verifies each frame's CRC-16, decodes Rice residuals
(any partition order, escapes included) and fixed or general linear predictors, and gives PCM blocks with their sample
offsets. All frames of a batch of documents are worked on together: sample by sample, across frames.

Null and empty texts are one frame of padding. Equal texts give equal streams, also in repeated rows; rows without an id
are kept. Long texts are worked on in batches of their own; columns besides the key and the text play no part. A stream that is damaged gets an error and no samples; it stops nothing else. Read are
mono streams of up to 24 bits without wasted bits; others get an error.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import tidy

FRAME, RATE = 192, 8000
#: Order of the predictors fitted to a frame, the bits of their weights, and what stands for such a predictor among fixed orders.
LPC, WEIGHT, FIT = 4, 8, 9
#: Frames between seek points, and payload bytes that are worked on at a time.
SEEK, CHUNK = 64, 1 << 20
_BLOCK_SIZES = {1: 192} | {i: 576 << (i - 2) for i in range(2, 6)} | {i: 256 << (i - 8) for i in range(8, 16)}
_BITS = {1: 8, 2: 12, 4: 16, 5: 20, 6: 24}
#: Fixed predictors of order 0 to 4: the weights of the samples before, nearest first (fixed values of the format).
_FIXED = ((), (1,), (2, -1), (3, -3, 1), (4, -6, 4, -1))


def _crc_table(polynomial: int, bits: int) -> np.ndarray:
    table = np.arange(256, dtype=np.uint32) << (bits - 8)
    for _ in range(8):
        table = np.where(table >> (bits - 1) & 1, table << 1 ^ polynomial, table << 1)
    return (table & ((1 << bits) - 1)).astype(np.uint32)


_CRC8, _CRC16 = _crc_table(0x07, 8), _crc_table(0x8005, 16)


def _crc16(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Of each stretch of data."""
    crc, order = np.zeros(len(start), np.uint32), np.argsort(-size, kind="stable")
    at, left = start[order], size[order]
    own = np.zeros(len(start), np.uint32)
    n = len(start)
    for i in range(int(size.max(initial=0))):
        while n and left[n - 1] <= i:
            n -= 1
        c = own[:n]
        own[:n] = (c << 8 & 0xFF00) ^ _CRC16[(c >> 8) ^ data[at[:n] + i]]
    crc[order] = own
    return crc


def _coded_number(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Frame numbers in the format's UTF-8 like form: (rows of up to 7 bytes, lengths)."""
    size = 1 + (n > 0x7F).astype(int) + (n > 0x7FF) + (n > 0xFFFF) + (n > 0x1FFFFF) + (n > 0x3FFFFFF)
    out = np.zeros((len(n), 7), np.uint8)
    for s in np.unique(size):
        rows = size == s
        v = n[rows]
        if s == 1:
            out[rows, 0] = v
        else:
            for j in range(s - 1, 0, -1):
                out[rows, j] = 0x80 | (v & 0x3F)
                v = v >> 6
            out[rows, 0] = (0xFF << (8 - s) & 0xFF) | v
    return out, size


def _fitted(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Integer weights (nearest sample first), shifts and residuals of the predictors that fit the rows of x (Levinson and Durbin)."""
    y = x.astype(np.float64)
    r = np.stack([(y[:, lag:] * y[:, : FRAME - lag]).sum(axis=1) for lag in range(LPC + 1)])
    error, a = np.maximum(r[0], 1e-9), np.zeros((LPC, len(x)))
    for i in range(LPC):
        k = (r[i + 1] - (a[:i] * r[i:0:-1]).sum(axis=0)) / error
        a[:i] -= k * a[:i][::-1].copy()
        a[i] = k
        error = np.maximum(error * (1 - k * k), 1e-9)
    most = (1 << (WEIGHT - 1)) - 1
    shift = np.clip(np.floor(np.log2(most / np.maximum(np.abs(a).max(axis=0), 1e-9))), 0, 15).astype(np.int32)
    weights = np.clip(np.rint(a * np.exp2(shift)), -most - 1, most).astype(np.int32)
    guess = np.zeros((len(x), FRAME - LPC), np.int32)
    for j in range(LPC):
        guess += weights[j][:, None] * x[:, LPC - 1 - j : FRAME - 1 - j]
    return weights.T, shift, x[:, LPC:] - (guess >> shift[:, None])


def _frames(x: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the frames that hold the rows of x (signed 8-bit), and each frame's size."""
    x = x.astype(np.int32)
    n = len(x)
    best, order, rice = np.full(n, 8 * FRAME, np.int64), np.full(n, -1), np.zeros(n, np.int64)  # order -1: verbatim
    weights, shift, fitted = _fitted(x)
    residual = x
    for o in (*range(5), FIT):
        if o == FIT:
            residual = fitted
        elif o:
            residual = residual[:, 1:] - residual[:, :-1]
        zig = (residual << 1) ^ (residual >> 31)
        head = 10 + 8 * (FRAME - residual.shape[1]) + (9 + WEIGHT * LPC) * (o == FIT)
        # the best parameter is near the logarithm of the mean
        mean = np.maximum(zig.mean(axis=1), 0.5)
        near = np.clip(np.floor(np.log2(mean)), 0, 8).astype(np.int32)
        for k in (near, np.maximum(near - 1, 0)):
            cost = head + residual.shape[1] * (k + 1) + (zig >> k[:, None]).sum(axis=1)
            better = cost < best
            best[better], order[better], rice[better] = cost[better], o, k[better]
    flat = (x == x[:, :1]).all(axis=1)
    best[flat], order[flat] = 8, -2
    coded, number_size = _coded_number(numbers)
    head = 5 + number_size
    size = head + (8 + best + 7) // 8 + 2
    start = np.cumsum(size) - size
    bits = np.zeros(8 * int(size.sum()), np.uint8)
    body = 8 * (start + head)  # of the subframe

    def put(at: np.ndarray, value: np.ndarray | int, width: int) -> None:
        for j in range(width):
            bits[at + (width - 1 - j)] = (value >> j) & 1

    put(body, np.where(order == -2, 0, np.where(order == -1, 2, np.where(order == FIT, (31 + LPC) << 1, (8 + order) << 1))), 8)
    rows = np.flatnonzero(order == -2)
    put(body[rows] + 8, x[rows, 0] & 0xFF, 8)
    rows = np.flatnonzero(order == -1)
    if len(rows):
        bits[body[rows, None] + 8 + np.arange(8 * FRAME)] = np.unpackbits(x[rows].astype(np.uint8), axis=1)
    for o, k in {(int(o), int(k)) for o, k in zip(order, rice) if o >= 0}:
        rows = np.flatnonzero((order == o) & (rice == k))
        at = body[rows] + 8
        warm = LPC if o == FIT else o
        for j in range(warm):
            put(at + 8 * j, x[rows, j] & 0xFF, 8)
        at = at + 8 * warm
        if o == FIT:
            put(at, WEIGHT - 1, 4)
            put(at + 4, shift[rows], 5)
            for j in range(LPC):
                put(at + 9 + WEIGHT * j, weights[rows, j] & ((1 << WEIGHT) - 1), WEIGHT)
            at = at + 9 + WEIGHT * LPC
        put(at + 6, k, 4)  # method 0 and partition order 0 are six zero bits
        r = fitted[rows] if o == FIT else np.diff(x[rows], n=o, axis=1)
        zig = (r << 1) ^ (r >> 31)
        stop = at[:, None] + 10 + np.cumsum((zig >> k) + 1 + k, axis=1)
        bits[stop - 1 - k] = 1
        for j in range(k):
            bits[stop - 1 - j] = (zig >> j) & 1
    data = np.packbits(bits)
    data[start], data[start + 1], data[start + 2], data[start + 3] = 0xFF, 0xF8, 0x14, 0x02
    crc = np.zeros(n, np.uint32)
    for b in (0xFF, 0xF8, 0x14, 0x02):
        crc = _CRC8[crc ^ b]
    for j in range(7):
        rows = np.flatnonzero(number_size > j)
        data[start[rows] + 4 + j] = coded[rows, j]
        crc[rows] = _CRC8[crc[rows] ^ coded[rows, j]]
    data[start + head - 1] = crc
    crc = _crc16(data, start, size - 2)
    data[start + size - 2], data[start + size - 1] = crc >> 8, crc & 0xFF
    return data, size


def padded(payload: bytes) -> bytes:
    """With bytes 32 appended up to a positive multiple of the frame size."""
    return payload + b" " * ((-len(payload)) % FRAME or (0 if payload else FRAME))


def encode(payloads: list[bytes]) -> list[bytes]:
    """A stream for each padded payload; byte b is the sample b - 128."""
    counts = [len(p) // FRAME for p in payloads]
    x = (np.frombuffer(b"".join(payloads), np.uint8) ^ 0x80).view(np.int8).reshape(-1, FRAME)
    numbers = np.concatenate([np.arange(c) for c in counts])
    data, size = _frames(x, numbers)
    ends = np.cumsum(size)
    out, at = [], 0
    for c in counts:
        own, base = size[at : at + c], int(ends[at] - size[at])
        low, high = int(own.min()), int(own.max())
        total = c * FRAME
        info = (FRAME << 16 | FRAME).to_bytes(4, "big") + low.to_bytes(3, "big") + high.to_bytes(3, "big") + (RATE << 44 | 0 << 41 | 7 << 36 | total).to_bytes(8, "big") + hashlib.md5(x[at : at + c].tobytes()).digest()
        offsets = np.cumsum(own) - own
        points = b"".join((i * FRAME).to_bytes(8, "big") + int(offsets[i]).to_bytes(8, "big") + FRAME.to_bytes(2, "big") for i in range(0, c, SEEK))
        out.append(b"fLaC\0" + len(info).to_bytes(3, "big") + info + b"\x83" + len(points).to_bytes(3, "big") + points + data[base : int(ends[at + c - 1])].tobytes())
        at += c
    return out


def seek_points(stream: bytes) -> list[tuple[int, int]]:
    """(sample, byte offset in the stream) of each seek point."""
    points, at, last = [], 4, False
    while not last:
        last, kind, size = bool(stream[at] & 0x80), stream[at] & 0x7F, int.from_bytes(stream[at + 1 : at + 4], "big")
        if kind == 3:
            points = [(int.from_bytes(stream[p : p + 8], "big"), int.from_bytes(stream[p + 8 : p + 16], "big")) for p in range(at + 4, at + 4 + size, 18)]
        at += 4 + size
    return [(s, b + at) for s, b in points if s != 2**64 - 1]


class _Reader:
    """Bits of a byte string, read at many places at once."""

    def __init__(self, data: np.ndarray):
        wide = np.concatenate([data, np.zeros(8, np.uint8)])
        self.words = np.zeros(len(data) + 4, np.uint64)
        for j in range(4):
            self.words |= wide[j : len(data) + 4 + j].astype(np.uint64) << np.uint64(8 * (3 - j))
        bits = np.unpackbits(data)
        place = np.where(bits, np.arange(len(bits), dtype=np.int32), np.int32(len(bits)))
        self.next_one = np.append(np.minimum.accumulate(place[::-1])[::-1], np.int32(len(bits)))

    def take(self, at: np.ndarray, width) -> np.ndarray:
        """Unsigned values of up to 25 bits."""
        w = np.asarray(width)
        return (self.words[at >> 3].astype(np.int64) >> (32 - (at & 7) - w)) & ((1 << w) - 1)

    def signed(self, at: np.ndarray, width: int) -> np.ndarray:
        v = self.take(at, width)
        return v - ((v >> (width - 1)) << width)


def _find(data: np.ndarray, owner_end: np.ndarray, owner_start: np.ndarray) -> tuple[np.ndarray, ...]:
    """Frames by checked headers: start, header size, number, block code, bits code, owner."""
    at = np.flatnonzero((data[:-1] == 0xFF) & (data[1:] == 0xF8))
    at = at[at + 6 <= len(data)]
    wide = np.concatenate([data, np.zeros(16, np.uint8)])
    first = wide[at + 4].astype(np.int64)
    size = np.where(first < 0x80, 1, np.where(first >> 5 == 6, 2, np.where(first >> 4 == 14, 3, np.where(first >> 3 == 30, 4, np.where(first >> 2 == 62, 5, 0)))))
    at, first, size = at[size > 0], first[size > 0], size[size > 0]
    number = np.where(size == 1, first, first & ((1 << (7 - size)) - 1))
    for j in range(1, 5):
        number = np.where(size > j, number << 6 | (wide[at + 4 + j] & 0x3F), number)
    block = wide[at + 2].astype(np.int64) >> 4
    extra = (block == 6) * 1 + (block == 7) * 2 + (wide[at + 2] & 15 == 12) * 1 + np.isin(wide[at + 2] & 15, (13, 14)) * 2
    head = 4 + size + extra
    crc = np.zeros(len(at), np.uint32)
    for j in range(int(head.max(initial=0))):
        on = head > j
        crc[on] = _CRC8[crc[on] ^ wide[at[on] + j]]
    good = crc == wide[at + head]
    at, head, number, block = at[good], head[good] + 1, number[good], block[good]
    owner = np.searchsorted(owner_end, at, side="right")
    inside = (owner < len(owner_end)) & (at >= owner_start[np.minimum(owner, len(owner_end) - 1)])
    at, head, number, block, owner = (v[inside] for v in (at, head, number, block, owner))
    # a header's pattern may also occur within a frame: numbers run from 0 in each stream
    keep, want, last = np.ones(len(at), bool), 0, -1
    rank = np.arange(len(at)) - np.searchsorted(owner, owner)
    if not (rank == number).all():
        for i in range(len(at)):
            want = 0 if owner[i] != last else want
            last = owner[i]
            keep[i] = number[i] == want
            want += int(keep[i])
    return at[keep], head[keep], number[keep], block[keep], wide[at[keep] + 3].astype(np.int64), owner[keep]


def _subframes(read: _Reader, at: np.ndarray, kind: int, size: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Samples of frames that share subframe kind, block size and sample bits; at: after the subframe's header."""
    n = len(at)
    out = np.zeros((n, size), np.int64)
    if kind == 0:
        out[:] = read.signed(at, bits)[:, None]
        return out, at + bits
    if kind == 1:
        for i in range(size):
            out[:, i] = read.signed(at + i * bits, bits)
        return out, at + size * bits
    order = kind - 8 if kind < 32 else kind - 31
    for i in range(order):
        out[:, i] = read.signed(at + i * bits, bits)
    at = at + order * bits
    if kind >= 32:
        width = read.take(at, 4) + 1
        shift = read.signed(at + 4, 5)
        at = at + 9
        weights = np.zeros((n, order), np.int64)
        for i in range(order):
            v = read.take(at, width)
            weights[:, i] = v - ((v >> (width - 1)) << width)
            at = at + width
    else:
        weights, shift = np.tile(np.array(_FIXED[order], np.int64), (n, 1)), np.zeros(n, np.int64)
    method, parts = read.take(at, 2), read.take(at + 2, 4)
    at = at + 6
    param_bits = np.where(method == 1, 5, 4)
    per = size >> parts
    k = np.zeros(n, np.int64)
    raw = np.zeros(n, np.int64)  # bits of an unencoded partition, 0 if Rice coded
    escaped = np.zeros(n, bool)
    for i in range(order, size):
        new = (i == order) | (i % per == 0)
        if new.any():
            v = read.take(at, param_bits)
            esc = v == (1 << param_bits) - 1
            k = np.where(new, v, k)
            at = np.where(new, at + param_bits, at)
            raw = np.where(new & esc, read.take(at, 5), raw)
            at = np.where(new & esc, at + 5, at)
            escaped = np.where(new, esc, escaped)
        one = read.next_one[np.minimum(at, len(read.next_one) - 1)].astype(np.int64)
        u = (one - at) << np.where(escaped, 0, k) | read.take(np.minimum(one + 1, 8 * len(read.words) - 8), np.where(escaped, 0, k))
        r = (u >> 1) ^ -(u & 1)
        nxt = one + 1 + k
        if escaped.any():
            v = read.take(at, raw)
            v = np.where(raw > 0, v - ((v >> np.maximum(raw - 1, 0)) << raw), 0)
            r, nxt = np.where(escaped, v, r), np.where(escaped, at + raw, nxt)
        at = nxt
        if order:
            guess = weights[:, 0] * out[:, i - 1]
            for j in range(1, order):
                guess += weights[:, j] * out[:, i - 1 - j]
            r = r + (guess >> shift)
        out[:, i] = r
    return out, at


def decode(streams: list[bytes]) -> list[tuple[np.ndarray | None, np.ndarray | None, str | None]]:
    """For each stream: samples, the byte offset of each frame in the stream, error."""
    result: list[tuple] = [(None, None, "not a FLAC stream")] * len(streams)
    spans, audio = [], []
    for i, s in enumerate(streams):
        if s[:4] != b"fLaC" or len(s) < 42:
            continue
        at, last, info = 4, False, b""
        while not last and at + 4 <= len(s):
            last, kind, size = bool(s[at] & 0x80), s[at] & 0x7F, int.from_bytes(s[at + 1 : at + 4], "big")
            info = s[at + 4 : at + 4 + size] if kind == 0 else info
            at += 4 + size
        fields = int.from_bytes(info[10:18], "big")
        if fields >> 41 & 7:
            result[i] = (None, None, "more than one channel")
            continue
        spans.append((i, at, fields & (1 << 36) - 1, info[18:34], (fields >> 36 & 31) + 1, int.from_bytes(info[:2], "big")))
        audio.append(s[at:])
    if not spans:
        return result
    data = np.frombuffer(b"".join(audio), np.uint8)
    ends = np.cumsum([len(a) for a in audio])
    starts = ends - [len(a) for a in audio]
    at, head, number, block, coded_bits, owner = _find(data, ends, starts)
    if not len(at):
        return [(None, None, "no frames") if r[2] == "not a FLAC stream" and s[:4] == b"fLaC" else r for r, s in zip(result, streams)]
    stop = np.append(at[1:], 0)
    tail = np.append(owner[1:] != owner[:-1], True)
    stop[tail] = ends[owner[tail]]
    crc = _crc16(data, at, stop - at - 2)
    good = crc == (data[stop - 2].astype(np.uint32) << 8 | data[stop - 1])
    read = _Reader(data)
    body = 8 * (at + head)
    kinds = read.take(body, 8)
    width = np.array([_BITS.get(int(c) >> 1 & 7, 0) for c in coded_bits])
    width = np.where((coded_bits >> 1 & 7) == 0, np.array([s[4] for s in spans])[owner], width)
    sizes = np.array([_BLOCK_SIZES.get(int(b), 0) for b in block])
    for code, extra in ((6, 1), (7, 2)):
        rows = block == code
        if rows.any():
            sizes[rows] = read.take(8 * (at[rows] + head[rows] - 1 - extra), 8 * extra) + 1
    good &= (kinds & 1 == 0) & (sizes > 0) & (width > 0) & (coded_bits >> 4 == 0)
    kinds = kinds >> 1
    good &= (kinds < 2) | ((kinds >= 8) & (kinds < 13)) | (kinds >= 32)
    samples: list = [None] * len(at)
    for kind, size, bits in {(int(a), int(b), int(c)) for a, b, c in zip(kinds[good], sizes[good], width[good])}:
        rows = np.flatnonzero(good & (kinds == kind) & (sizes == size) & (width == bits))
        got, done = _subframes(read, body[rows] + 8, kind, size, bits)
        good[rows[(done + 7) // 8 != stop[rows] - 2]] = False
        for i, row in zip(rows, got):
            samples[i] = row
    bounds = np.searchsorted(owner, np.arange(len(spans) + 1))
    for j, (i, base, total, digest, bits, _) in enumerate(spans):
        own = slice(int(bounds[j]), int(bounds[j + 1]))
        if own.stop == own.start or not good[own].all():
            result[i] = (None, None, "no frames" if own.stop == own.start else "a frame's checksum or code is wrong")
            continue
        pcm = np.concatenate(samples[own])
        wide = (bits + 7) // 8
        flat = pcm.astype("<i4").view(np.uint8).reshape(-1, 4)[:, :wide].tobytes()
        if total and len(pcm) != total:
            result[i] = (None, None, f"{len(pcm)} samples, not {total}")
        elif digest != bytes(16) and hashlib.md5(flat).digest() != digest:
            result[i] = (None, None, "the digest of the samples is wrong")
        else:
            result[i] = (pcm, at[own] - starts[j] + base, None)
    return result


def summary(pcm: np.ndarray) -> str:
    """Peak, mean square and sign changes of the samples, and a histogram of 16 levels."""
    x = pcm.astype(np.int64)
    levels = np.bincount((x + 128) >> 4, minlength=16)
    return f"n={len(x)};low={x.min()};high={x.max()};sum={x.sum()};squares={(x * x).sum()};crossings={int((np.signbit(x[1:]) != np.signbit(x[:-1])).sum())};levels={','.join(map(str, levels))}"


def _chunks(sizes: list[int]) -> Iterator[slice]:
    start, total = 0, 0
    for i, s in enumerate(sizes):
        if total and total + s > CHUNK:
            yield slice(start, i)
            start, total = i, 0
        total += s
    if sizes:
        yield slice(start, len(sizes))


def encode_column(df: DataFrame, key: str = "doc_id", text: str = "text", media: str = "media") -> DataFrame:
    """key, n_bytes and the stream of each text in UTF-8."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = [t or b"" for t in b.column(1).cast(pa.binary()).to_pylist()]
            for s in _chunks([len(r) + FRAME for r in raw]):
                yield pa.RecordBatch.from_arrays([b.column(0)[s], pa.array([len(r) for r in raw[s]], pa.int64()), pa.array(encode([padded(r) for r in raw[s]]), pa.binary())], names=[key, "n_bytes", media])

    return df.select(key, text).mapInArrow(tidy(run), f"{key} {df.schema[key].dataType.simpleString()}, n_bytes long, {media} binary")


def pcm_blocks(pcm: np.ndarray, offsets: np.ndarray, frames: int = SEEK) -> list[tuple[int, int, np.ndarray]]:
    """(sample offset, byte offset in the stream, samples) of each run of `frames` frames; all but the last frame are equally long."""
    per = len(pcm) // len(offsets) if len(pcm) % len(offsets) == 0 else int(np.ceil(len(pcm) / len(offsets)))
    return [(i * per, int(offsets[i]), pcm[i * per : (i + frames) * per]) for i in range(0, len(offsets), frames)]


def decode_blocks(df: DataFrame, key: str = "doc_id", media: str = "media", frames: int = SEEK) -> DataFrame:
    """PCM blocks of `frames` frames: key, sample_offset, byte_offset in the stream, pcm (little-endian 32-bit), error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = [m or b"" for m in b.column(1).to_pylist()]
            for s in _chunks([len(r) for r in raw]):
                rows = []
                for k, (pcm, offsets, error) in zip(b.column(0)[s].to_pylist(), decode(raw[s])):
                    if error:
                        rows.append((k, None, None, None, error))
                        continue
                    rows += [(k, sample, byte, own.astype("<i4").tobytes(), None) for sample, byte, own in pcm_blocks(pcm, offsets, frames)]
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (b.schema.field(0).type, pa.int64(), pa.int64(), pa.binary(), pa.string()))], names=[key, "sample_offset", "byte_offset", "pcm", "error"])

    return df.select(key, media).mapInArrow(tidy(run), f"{key} {df.schema[key].dataType.simpleString()}, sample_offset long, byte_offset long, pcm binary, error string")


def digests(df: DataFrame, key: str = "doc_id", media: str = "media") -> DataFrame:
    """What reading an 8-bit stream back gives, from its PCM blocks: sizes, checksums, a feature string, and where each block begins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = b.column(2).to_pylist()
            for s in _chunks([len(r) for r in raw]):
                cols = [[] for _ in range(7)]
                for stream, (pcm, offsets, error) in zip(raw[s], decode(raw[s])):
                    if error:
                        raise ValueError(f"a stream just written can't be read: {error}")
                    blocks = pcm_blocks(pcm, offsets)
                    payload = b"".join([(own + 128).astype(np.uint8).tobytes() for _, _, own in blocks])
                    seek = [{"sample_offset": sample, "byte_offset": byte} for sample, byte, _ in blocks]
                    for c, v in zip(cols, (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(stream), hashlib.sha256(stream).hexdigest(), summary(pcm), seek)):
                        c.append(v)
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.struct([("sample_offset", pa.int64()), ("byte_offset", pa.int64())])))
                yield pa.RecordBatch.from_arrays([b.column(0)[s], b.column(1)[s], *(pa.array(c, t) for c, t in zip(cols, kinds))], names=[key, "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "blocks"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, "n_bytes", media).mapInArrow(tidy(run), f"{key} {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, blocks array<struct<sample_offset:bigint,byte_offset:bigint>>")
