"""FLAC media columns: lossless encoding of 8-bit mono samples, and a decoder that yields PCM blocks with seekable sample offsets.

The decoder reads the stream's metadata (STREAMINFO with the MD5 of the samples, SEEKTABLE), finds the frames, verifies each frame's header CRC-8 and footer
CRC-16, decodes constant, verbatim, fixed and LPC subframes with Rice-coded residuals, and checks the MD5. The serial parts run over many frames in
parallel lanes: Rice codes, CRCs and linear prediction one step for all frames at a time (several partitions in a frame by precomputed jumps from code to code).

Defined results: null is the empty text; texts are padded with bytes 0 to a positive multiple of 64 bytes, so no stream is empty; equal texts give
equal streams; a damaged stream raises an error that names the frame; repeated rows get equal results; an empty table gives an empty result; extra
columns are ignored. A text is handled whole in one task, with memory in proportion to it.
"""

from __future__ import annotations

import hashlib
import json
import struct
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.common import ship

BLOCK = 4096
RATE = 8000
UNIT = 64
LPC_ORDER = 2
PRECISION = 12
LANES = 512
#: Bytes of frames that are read at a time, about.
PART = 1 << 20
#: Predictor coefficients of the fixed subframes of order 0 to 4.
FIXED = [[], [1], [2, -1], [3, -3, 1], [4, -6, 4, -1]]


def _crc_table(poly: int, bits: int) -> np.ndarray:
    table, top = [], 1 << (bits - 1)
    for i in range(256):
        c = i << (bits - 8)
        for _ in range(8):
            c = ((c << 1) ^ poly) if c & top else c << 1
        table.append(c & ((1 << bits) - 1))
    return np.array(table, np.uint16)


#: The generator polynomials of the format, x^8+x^2+x+1 and x^16+x^15+x^2+1.
CRC8, CRC16 = _crc_table(0x07, 8), _crc_table(0x8005, 16)
_one = np.arange(65536, dtype=np.uint32)
_one = ((_one << 8) & 0xFFFF) ^ CRC16[_one >> 8]
CRC16_PAIR = (((_one << 8) & 0xFFFF) ^ CRC16[_one >> 8]).astype(np.uint16)  # two bytes at a step


def crc8(data: bytes) -> int:
    c = 0
    for b in data:
        c = int(CRC8[c ^ b])
    return c


def crc16_lanes(buf: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-16 of many byte ranges at once."""
    order = np.argsort(-size, kind="stable")
    at, left, c = start[order].copy(), size[order].copy(), np.zeros(len(size), np.uint16)
    active = len(size)
    pairs = left // 2
    for step in range(int(pairs.max(initial=0))):
        while active and pairs[active - 1] <= step:
            active -= 1
        a = at[:active] + 2 * step
        c[:active] = CRC16_PAIR[c[:active] ^ ((buf[a].astype(np.uint16) << 8) | buf[a + 1])]
    odd = np.flatnonzero(left % 2)
    c[odd] = ((c[odd].astype(np.uint32) << 8) & 0xFFFF) ^ CRC16[(c[odd] >> 8) ^ buf[at[odd] + left[odd] - 1]]
    out = np.empty_like(c)
    out[order] = c
    return out


def _utf8(n: int) -> bytes:
    """A frame number in the format's extended UTF-8."""
    if n < 0x80:
        return bytes([n])
    more = next(k for k in range(1, 7) if n < 1 << (5 * k + 6 if k < 6 else 36))
    head = (0xFF << (7 - more)) & 0xFF if more < 6 else 0xFE
    return bytes([head | (n >> (6 * more)), *(0x80 | (n >> (6 * i)) & 0x3F for i in reversed(range(more)))])


def _frame_header(number: int, n: int) -> bytes:
    kind = bytes([(0xC0 if n == BLOCK else 0x70) | 0x04])  # 4096 samples, or a 16-bit count; 8 kHz
    head = b"\xff\xf8" + kind + b"\x02" + _utf8(number) + (b"" if n == BLOCK else struct.pack(">H", n - 1))
    return head + bytes([crc8(head)])


def _lpc(x: np.ndarray, order: int) -> tuple[list[int], int] | None:
    """Quantised predictor of one block by autocorrelation and Levinson-Durbin; None if it doesn't pay."""
    f = x.astype(np.float64)
    r = np.array([f[: len(f) - k] @ f[k:] for k in range(order + 1)])
    if r[0] == 0:
        return None
    a, error = np.zeros(0), r[0]
    for i in range(order):
        k = (r[i + 1] - a @ r[i:0:-1][: len(a)]) / error if len(a) else r[1] / error
        a = np.append(a - k * a[::-1], k)
        error *= 1 - k * k
        if error <= 0:
            break
    top = np.abs(a).max()
    if not np.isfinite(top) or top == 0:
        return None
    shift = int(np.clip(PRECISION - 1 - np.ceil(np.log2(top) + 1e-9), 0, 15))
    limit = 1 << (PRECISION - 1)
    return [int(np.clip(round(v * (1 << shift)), -limit, limit - 1)) for v in a], shift


def _residual(x: np.ndarray, coefficients: list[int], shift: int) -> np.ndarray:
    p = len(coefficients)
    guess = np.zeros(len(x) - p, np.int64)
    for k, c in enumerate(coefficients):
        guess += c * x[p - 1 - k : len(x) - 1 - k]
    return x[p:] - (guess >> shift)


def _bits(value: int, n: int) -> np.ndarray:
    return np.array([(value >> (n - 1 - i)) & 1 for i in range(n)], np.uint8)


def _rice(folded: np.ndarray) -> tuple[int, int]:
    """Best Rice parameter by the mean, and the bits it needs."""
    mean = folded.mean() if len(folded) else 0.0
    best = max(0, int(np.log2(mean + 1e-9)) if mean >= 1 else 0)
    return min(((k, int((folded >> k).sum()) + len(folded) * (k + 1)) for k in range(max(0, best - 1), min(14, best + 1) + 1)), key=lambda t: t[1])


def _subframe(x: np.ndarray, lpc_order: int) -> bytes:
    """Smallest of constant, fixed, LPC and verbatim subframes, padded to a byte."""
    if (x == x[0]).all():
        return np.packbits(np.concatenate([_bits(0, 8), _bits(int(x[0]) & 0xFF, 8)])).tobytes()
    d, sums = x, []
    for _ in range(min(4, len(x) - 1) + 1):
        sums.append((np.abs(d).mean(), len(sums)))
        d = np.diff(d)
    p = min(sums)[1]
    options = [(0b001000 | p, FIXED[p], 0, 0)]
    if lpc_order and len(x) > 64 and (found := _lpc(x, lpc_order)):
        options.append((0b100000 | (len(found[0]) - 1), *found, PRECISION))
    best = None
    for code, coefficients, shift, precision in options:
        e = _residual(x, coefficients, shift)
        folded = (e << 1) ^ (e >> 63)
        k, n = _rice(folded)
        n += 8 * len(coefficients) + (9 + precision * len(coefficients) if precision else 0)
        if best is None or n < best[0]:
            best = (n, code, coefficients, shift, precision, folded, k)
    n, code, coefficients, shift, precision, folded, k = best
    if n >= 8 * len(x):
        return bytes([0b00000010]) + (x & 0xFF).astype(np.uint8).tobytes()
    head = [_bits(code << 1, 8), *(_bits(int(v) & 0xFF, 8) for v in x[: len(coefficients)])]
    if precision:
        head += [_bits(precision - 1, 4), _bits(shift, 5), *(_bits(c & ((1 << precision) - 1), precision) for c in coefficients)]
    head += [_bits(0, 2), _bits(0, 4), _bits(k, 4)]
    ends = np.cumsum((folded >> k) + k + 1)
    body = np.zeros(int(ends[-1]), np.uint8)
    body[ends - k - 1] = 1
    for j in range(k):
        body[ends - 1 - j] = (folded >> j) & 1
    return np.packbits(np.concatenate([*head, body])).tobytes()


def pad(text: bytes) -> bytes:
    """Bytes 0 up to a positive multiple of UNIT."""
    return text.ljust(max(UNIT, -(-len(text) // UNIT) * UNIT), b"\0")


def encode(payload: bytes, lpc_order: int = LPC_ORDER) -> bytes:
    return encode_many([payload], lpc_order)[0]


def encode_many(payloads: list[bytes], lpc_order: int = LPC_ORDER) -> list[bytes]:
    """FLAC streams of 8-bit mono samples; a payload byte b is the sample b - 128. One seek point a frame."""
    samples = [np.frombuffer(p, np.uint8).astype(np.int64) - 128 for p in payloads]
    frames = [[_frame_header(i, len(x[a : a + BLOCK])) + _subframe(x[a : a + BLOCK], lpc_order) for i, a in enumerate(range(0, len(x), BLOCK))] for x in samples]
    size = np.array([len(f) for own in frames for f in own])
    crcs = iter(crc16_lanes(np.frombuffer(b"".join(f for own in frames for f in own), np.uint8), np.cumsum(size) - size, size).tolist())
    return [_stream(x, [f + next(crcs).to_bytes(2, "big") for f in own]) for x, own in zip(samples, frames, strict=True)]


def _stream(x: np.ndarray, frames: list[bytes]) -> bytes:
    block = min(max(len(x), 16), BLOCK)
    sizes = [len(f) for f in frames]
    info = struct.pack(">HH", block, block) + min(sizes).to_bytes(3, "big") + max(sizes).to_bytes(3, "big")
    info += ((RATE << 44) | (0 << 41) | (7 << 36) | len(x)).to_bytes(8, "big") + hashlib.md5(x.astype(np.int8).tobytes()).digest()
    starts = np.cumsum([0, *sizes[:-1]])
    points = b"".join(struct.pack(">QQH", i * BLOCK, int(s), min(BLOCK, len(x) - i * BLOCK)) for i, s in enumerate(starts))  # a text has less than 2**31 bytes, so these fit their block
    return b"fLaC" + b"\x00" + len(info).to_bytes(3, "big") + info + b"\x83" + len(points).to_bytes(3, "big") + points + b"".join(frames)


class Damaged(ValueError):
    """A stream that is not what it says."""


def _metadata(data: bytes) -> tuple[dict, list[tuple[int, int, int]], int]:
    if data[:4] != b"fLaC":
        raise Damaged("no FLAC marker")
    at, info, points = 4, None, []
    while True:
        last, kind, size = data[at] >> 7, data[at] & 0x7F, int.from_bytes(data[at + 1 : at + 4], "big")
        body = data[at + 4 : at + 4 + size]
        if kind == 0:
            packed = int.from_bytes(body[10:18], "big")
            info = {"block": struct.unpack(">H", body[2:4])[0], "rate": packed >> 44, "channels": (packed >> 41 & 7) + 1, "bits": (packed >> 36 & 31) + 1, "samples": packed & ((1 << 36) - 1), "md5": body[18:34]}
        elif kind == 3:
            points = [p for p in struct.iter_unpack(">QQH", body) if p[0] != (1 << 64) - 1]
        at += 4 + size
        if last:
            break
        if at + 4 > len(data):
            raise Damaged("metadata without an end")
    if info is None or info["channels"] != 1 or info["bits"] != 8:
        raise Damaged("not a mono stream of 8-bit samples")
    return info, points, at


def _header(data: bytes, at: int, info: dict) -> tuple[int, int, int]:
    """(first byte after the header, first sample, samples) of the frame at ``at``."""
    if data[at : at + 2] != b"\xff\xf8":
        raise Damaged(f"no frame at byte {at}")
    size_code, rate_code = data[at + 2] >> 4, data[at + 2] & 15
    i, first = at + 5, data[at + 4]
    number = first
    if first >= 0xC0:
        more = 8 - (first ^ 0xFF).bit_length() - 1
        number = first & ((1 << (6 - more)) - 1) if more < 6 else 0
        for _ in range(more):
            number = number << 6 | data[i] & 0x3F
            i += 1
    if size_code == 6:
        n, i = data[i] + 1, i + 1
    elif size_code == 7:
        n, i = struct.unpack(">H", data[i : i + 2])[0] + 1, i + 2
    else:
        n = 192 if size_code == 1 else 576 << (size_code - 2) if size_code < 6 else 256 << (size_code - 8)
    i += {12: 1, 13: 2, 14: 2}.get(rate_code, 0)
    if crc8(data[at:i]) != data[i]:
        raise Damaged(f"header checksum of the frame at byte {at}")
    return i + 1, number * info["block"], n


def _number(bits: np.ndarray, at: int, n: int, signed: bool = False) -> int:
    v = 0
    for b in bits[at : at + n].tolist():
        v = v << 1 | b
    return v - (1 << n) if signed and n and v >> (n - 1) else v


def _codes(bits: np.ndarray, at: int, k: int, n: int) -> tuple[np.ndarray, int]:
    """``n`` Rice codes from bit ``at`` on, and the bit after them."""
    ones = np.flatnonzero(bits[at:])
    stop = len(bits) - at
    following = np.full(stop + 1, stop, np.int32)  # of each bit: where the code that starts there ends
    if len(ones):
        runs = np.diff(ones, prepend=-1)
        following[: ones[-1] + 1] = np.repeat(np.minimum(ones + 1 + k, stop).astype(np.int32), runs)
    hops = [following]
    for _ in range(4):
        hops.append(hops[-1][hops[-1]])
    far, here = hops[4], 0
    at_code = np.zeros(-(-n // 16), np.int32)
    for i in range(len(at_code)):
        at_code[i] = here
        here = far[here]
    for hop in reversed(hops[:4]):
        at_code = np.stack([at_code, hop[at_code]], axis=1).ravel()
    at_code = at_code[:n]
    ends = following[at_code]
    if n and (not len(ones) or ends[-1] > stop or (ends - at_code < k + 1).any()):
        raise Damaged("residual runs out of the frame")
    low = np.zeros(n, np.int64)
    for j in range(k):
        low = low << 1 | bits[at + ends - k + j]
    quotient = (ends - at_code - 1 - k).astype(np.int64)
    folded = quotient << k | low
    return (folded >> 1) ^ -(folded & 1), at + (int(ends[-1]) if n else 0)


class Codes(NamedTuple):
    """A residual that is still to be read: ``n`` Rice codes with parameter ``k`` from bit ``at`` of the frame on."""

    at: int
    k: int
    n: int


def _codes_lanes(data: np.ndarray, bits: np.ndarray, start: np.ndarray, stop: np.ndarray, k: np.ndarray, size: np.ndarray) -> list[np.ndarray]:
    """The residuals of many frames in ``data``, one code of all frames at a time: ``size`` codes each, from bit ``start`` up to ``stop`` at most."""
    if (start > stop).any():
        raise Damaged("residual runs out of the frame")
    total = len(bits)
    ones = np.append(np.flatnonzero(bits.view(bool)), total).astype(np.int32)  # past the last one there is no end of a code
    rank = np.full(total + 32, len(ones) - 1, np.int32)  # of each bit: how many ones there are before it
    rank[0] = 0
    np.cumsum(bits[:-1], dtype=np.int32, out=rank[1:total])
    order = np.argsort(-size, kind="stable")
    start, stop, k, left = start[order].astype(np.int32), stop[order], k[order].astype(np.int32), size[order]
    steps = int(left.max(initial=0))
    hits, here, after = np.zeros((steps, len(left)), np.int32), start, k + 1
    for t, m in enumerate(np.searchsorted(-left, -np.arange(steps), side="left").tolist()):  # lanes that have more codes
        hit = ones[rank[here[:m]]]
        hits[t, :m] = hit
        here = hit + after[:m]
    hit = hits.T[np.arange(steps) < left[:, None]]  # lane by lane
    width, first = np.repeat(k, left), np.cumsum(left) - left
    low_at = hit + 1
    before = np.empty_like(hit)
    before[1:] = (low_at + width)[:-1]
    some = left > 0
    before[first[some]] = start[some]
    if (low_at[(first + left - 1)[some]] + k[some] > stop[some]).any():
        raise Damaged("residual runs out of the frame")
    wide = np.append(data, np.zeros(3, np.uint8)).astype(np.int32)
    window = wide[:-2] << 16 | wide[1:-1] << 8 | wide[2:]  # a parameter has at most 14 bits
    low = window[low_at >> 3] >> (24 - (low_at & 7) - width) & ((1 << width) - 1)
    folded = (hit - before) << width | low
    out: list = [None] * len(left)
    for i, e in zip(order.tolist(), np.split(((folded >> 1) ^ -(folded & 1)).astype(np.int64), first[1:]), strict=True):
        out[i] = e
    return out


def _read_frames(data: np.ndarray, frames: list[tuple[int, int, int]]) -> list[tuple[np.ndarray, np.ndarray, list[int], int, int]]:
    """_read_subframe() of many (first byte, end, samples) in ``data``, with all residuals read."""
    bits = np.unpackbits(data)
    read = [_read_subframe(bits[8 * a : 8 * b], n) for a, b, n in frames]
    late = [i for i, r in enumerate(read) if isinstance(r[1], Codes)]
    if late:
        start, stop, k, size = (np.array(x, np.int64) for x in zip(*((8 * frames[i][0] + read[i][1].at, 8 * frames[i][1], read[i][1].k, read[i][1].n) for i in late), strict=True))
        for i, e in zip(late, _codes_lanes(data, bits, start, stop, k, size), strict=True):
            read[i] = (read[i][0], e, *read[i][2:])
    return read


def _read_subframe(bits: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray | Codes, list[int], int, int]:
    """(warm-up samples, residual, coefficients, shift, wasted bits); samples without a predictor come as a residual of order 0.

    Wasted bits are low bits that are 0 in all samples of the frame; samples are coded without them. A residual in one partition is left to be read with those of other frames.
    """
    code, at, wasted = _number(bits, 1, 6), 8, 0
    if bits[0]:
        raise Damaged("a subframe without its leading zero")
    if bits[7]:
        wasted = int(bits[8:16].argmax()) + 1
        at += wasted
        if wasted > 7 or not bits[at - 1]:
            raise Damaged("no bits are left of the samples")
    width, none = 8 - wasted, np.zeros(0, np.int64)

    def plain(m: int) -> np.ndarray:
        raw = bits[at : at + width * m].reshape(m, width)
        if raw.size == 0:
            return none
        signed = np.concatenate([np.repeat(raw[:, :1], wasted, axis=1), raw], axis=1)  # the sign goes in front
        return np.packbits(signed).view(np.int8).astype(np.int64)

    if code == 0:
        return none, np.full(n, plain(1)[0]), [], 0, wasted
    if code == 1:
        return none, plain(n), [], 0, wasted
    if 8 <= code <= 12:
        order, shift = code - 8, 0
        coefficients = FIXED[order]
        warm = plain(order)
        at += width * order
    elif code >= 32:
        order = code - 31
        warm = plain(order)
        at += width * order
        precision, shift = _number(bits, at, 4) + 1, _number(bits, at + 4, 5, True)
        coefficients = [_number(bits, at + 9 + i * precision, precision, True) for i in range(order)]
        at += 9 + precision * order
    else:
        raise Damaged("reserved subframe")
    method, parts = _number(bits, at, 2), 1 << _number(bits, at + 2, 4)
    if method > 1:
        raise Damaged("reserved residual coding")
    width = 4 + method
    at += 6
    if parts == 1 and not method and (k := _number(bits, at, 4)) < 15:
        return warm, Codes(at + 4, k, n - order), coefficients, shift, wasted
    out = []
    for i in range(parts):
        m = n // parts - (order if i == 0 else 0)
        k = _number(bits, at, width)
        at += width
        if k == (1 << width) - 1:
            raw = _number(bits, at, 5)
            out.append(np.array([_number(bits, at + 5 + j * raw, raw, True) for j in range(m)], np.int64))
            at += 5 + raw * m
        else:
            found, at = _codes(bits, at, k, m)
            out.append(found)
    return warm, np.concatenate(out), coefficients, shift, wasted


def _predicted(frames: list[tuple[np.ndarray, np.ndarray, list[int], int, int]]) -> list[np.ndarray]:
    """Samples of all frames: one step of every predictor at a time."""
    out: list = [None] * len(frames)
    lanes = []
    for i, (_, residual, coefficients, _, _) in enumerate(frames):
        if coefficients:
            lanes.append(i)
        else:
            out[i] = residual
    for a in range(0, len(lanes), LANES):
        own = sorted(lanes[a : a + LANES], key=lambda i: -len(frames[i][1]))
        depth = max(len(frames[i][2]) for i in own)
        size = np.array([len(frames[i][1]) for i in own])
        c = np.zeros((depth, len(own)), np.int64)
        x = np.zeros((depth + int(size[0]), len(own)), np.int64)
        shift = np.array([frames[i][3] for i in own], np.int64)
        for j, i in enumerate(own):
            warm, residual, coefficients, _, _ = frames[i]
            c[: len(coefficients), j] = coefficients
            x[depth - len(warm) : depth, j] = warm
            x[depth : depth + len(residual), j] = residual
        live = np.searchsorted(-size, -np.arange(int(size[0])), side="left")  # lanes longer than the step
        for t, m in enumerate(live.tolist()):
            guess = c[0, :m] * x[depth + t - 1, :m]
            for k in range(1, depth):
                guess += c[k, :m] * x[depth + t - 1 - k, :m]
            x[depth + t, :m] += guess >> shift[:m]
        for j, i in enumerate(own):
            out[i] = x[depth - len(frames[i][0]) : depth + size[j], j]
    return [x << f[4] for x, f in zip(out, frames, strict=True)]


def decode_many(streams: list[bytes]) -> list[tuple[dict, list[tuple[int, int, bytes]]]]:
    """For each stream its facts and its PCM blocks (first sample, byte offset of the frame, samples as unsigned bytes)."""
    read, frames = [], []
    for data in streams:
        info, points, at = _metadata(data)
        first_frame, own = at, []
        bounds = [first_frame + p[1] for p in points]
        if not bounds or bounds[0] != first_frame or len(points) * info["block"] < info["samples"]:
            bounds = _scan(data, first_frame, info)
        for a, b in zip(bounds, [*bounds[1:], len(data)], strict=True):
            body, sample, n = _header(data, a, info)
            own.append((a, b, body, sample, n))
        read.append((info, own, first_frame))
    joined = np.frombuffer(b"".join(streams), np.uint8)
    base = np.cumsum([0, *map(len, streams)])[:-1]
    start = np.array([base[i] + f[0] for i, (_, own, _) in enumerate(read) for f in own], np.int64)
    size = np.array([f[1] - f[0] - 2 for _, own, _ in read for f in own], np.int64)
    stored = joined[start + size].astype(np.uint16) << 8 | joined[start + size + 1]
    if (bad := np.flatnonzero(crc16_lanes(joined, start, size) != stored)).size:
        raise Damaged(f"checksum of frame {int(bad[0])}")
    spans = [(int(base[i]) + body, int(base[i]) + b - 2, n) for i, (_, own, _) in enumerate(read) for _, b, body, _, n in own]
    a = 0
    while a < len(spans):  # a long text's frames are taken some at a time
        at, b = spans[a][0], a + 1
        while b < min(len(spans), a + LANES) and spans[b][1] - at <= PART:
            b += 1
        frames += _read_frames(joined[at : spans[b - 1][1]], [(x - at, y - at, n) for x, y, n in spans[a:b]])
        a = b
    samples = iter(_predicted(frames))
    out = []
    for info, own, first_frame in read:
        blocks = [(sample, a - first_frame, (next(samples) + 128).astype(np.uint8).tobytes()) for a, _, _, sample, _ in own]
        pcm = b"".join(b for _, _, b in blocks)
        if len(pcm) != info["samples"] or hashlib.md5((np.frombuffer(pcm, np.uint8) ^ 0x80).tobytes()).digest() != info["md5"]:
            raise Damaged("the samples are not those that were encoded")
        out.append((info | {"frames": len(blocks)}, blocks))
    return out


def _scan(data: bytes, at: int, info: dict) -> list[int]:
    """Frame starts of a stream without a complete seek table: sync codes whose header checksum and sample number fit."""
    found, sample = [], 0
    while (at := data.find(b"\xff\xf8", at)) >= 0:
        try:
            _, first, n = _header(data, at, info)
        except (Damaged, IndexError):
            at += 1
            continue
        if first == sample:
            found.append(at)
            sample += n
        at += 1
    return found


def features(pcm: bytes, info: dict) -> str:
    """Facts about the decoded samples, as JSON with sorted keys."""
    x = np.frombuffer(pcm, np.uint8).astype(np.int64) - 128
    return json.dumps({"bits": info["bits"], "frames": info["frames"], "mean": round(float(x.mean()), 6), "peak": int(np.abs(x).max()), "rate": info["rate"], "rms": round(float(np.sqrt((x * x).mean())), 6), "samples": len(x), "sign_changes": int((np.diff(x >= 0)).sum())}, sort_keys=True)


def _groups(batch: pa.RecordBatch, column: int, most: int = 1 << 20) -> Iterator[tuple[int, list[bytes]]]:
    held, size, at = [], 0, 0
    for i, v in enumerate(batch.column(column).cast(pa.binary()).to_pylist()):
        v = v or b""
        if held and size + len(v) > most:
            yield at, held
            held, size, at = [], 0, i
        held.append(v)
        size += len(v)
    if held:
        yield at, held


def encode_texts(docs: DataFrame, lpc_order: int = LPC_ORDER, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, media): every whole text as a FLAC stream."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in _groups(batch, 1):
                media = encode_many([pad(t) for t in texts], lpc_order)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), pa.array([len(t) for t in texts], pa.int64()), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, n_bytes long, media binary")


def _decoded(media: DataFrame, schema: str, rows) -> DataFrame:
    ship(media.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, streams in _groups(batch, 2):
                yield rows(batch.slice(at, len(streams)), streams, decode_many(streams))

    return media.select("doc_id", "n_bytes", "media").mapInArrow(run, schema)


def pcm_blocks(media: DataFrame) -> DataFrame:
    """(doc_id, block, first_sample, n_samples, frame_offset, pcm): one row per frame; a range of samples is read from the rows whose range it meets."""

    def rows(part: pa.RecordBatch, streams: list[bytes], found: list) -> pa.RecordBatch:
        flat = [(d, i, s, len(b), o, b) for d, (_, blocks) in zip(part.column(0).to_pylist(), found, strict=True) for i, (s, o, b) in enumerate(blocks)]
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
        names = ["doc_id", "block", "first_sample", "n_samples", "frame_offset", "pcm"]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in flat], t) for k, t in enumerate(kinds)], names=names)

    return _decoded(media, "doc_id long, block int, first_sample long, n_samples int, frame_offset long, pcm binary", rows)


def digests(media: DataFrame) -> DataFrame:
    """One row per stream, from the PCM that was read back: lengths, checksums and features."""

    def rows(part: pa.RecordBatch, streams: list[bytes], found: list) -> pa.RecordBatch:
        pcm = [b"".join(b for _, _, b in blocks) for _, blocks in found]
        made = {
            "payload_bytes": pa.array([len(p) for p in pcm], pa.int64()),
            "payload_sha256": pa.array([hashlib.sha256(p).hexdigest() for p in pcm]),
            "tail_crc32": pa.array([zlib.crc32(p[-UNIT:]) for p in pcm], pa.int64()),
            "media_bytes": pa.array([len(s) for s in streams], pa.int64()),
            "media_sha256": pa.array([hashlib.sha256(s).hexdigest() for s in streams]),
            "feature": pa.array([features(p, info) for p, (info, _) in zip(pcm, found, strict=True)]),
        }
        return pa.RecordBatch.from_arrays([part.column(0), part.column(1), *made.values()], names=["doc_id", "n_bytes", *made])

    return _decoded(media, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string", rows)
