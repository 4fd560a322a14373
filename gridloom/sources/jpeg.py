"""Grey and BGR images as baseline JPEG files: cosine transform, quantisation, and a Huffman code of the image's own."""

from __future__ import annotations

import heapq
import struct

import numpy as np

#: The usual quantisation of luminance for quality 50, by rows.
QUANT = (
    16, 11, 10, 16, 24, 40, 51, 61, 12, 12, 14, 19, 26, 58, 60, 55, 14, 13, 16, 24, 40, 57, 69, 56, 14, 17, 22, 29, 51, 87, 80, 62,
    18, 22, 37, 56, 68, 109, 103, 77, 24, 35, 55, 64, 81, 104, 113, 92, 49, 64, 78, 87, 103, 121, 120, 101, 72, 92, 95, 98, 112, 100, 103, 99,
)
#: Places of a block in the order of their diagonals, each run through the other way round than the one before.
ZIGZAG = np.array(sorted(range(64), key=lambda i: (i // 8 + i % 8, i // 8 if (i // 8 + i % 8) % 2 else i % 8)))
_COSINES = np.array([[(0.125**0.5 if u == 0 else 0.5) * np.cos((2 * x + 1) * u * np.pi / 16) for x in range(8)] for u in range(8)])
END, ZEROS = 0x00, 0xF0


def quantisation(quality: int) -> np.ndarray:
    """Divisors of a block's coefficients, by rows."""
    if not 1 <= quality <= 100:
        raise ValueError("quality must lie between 1 and 100")
    scale = 5000 / quality if quality < 50 else 200 - 2 * quality
    return np.clip(np.floor((np.array(QUANT) * scale + 50) / 100), 1, 255).astype(np.int64)


def planes(image: np.ndarray) -> list[np.ndarray]:
    if image.ndim == 2:
        return [image.astype(np.float64)]
    b, g, r = (image[..., k].astype(np.float64) for k in range(3))
    y = 0.299 * r + 0.587 * g + 0.114 * b
    return [y, (b - y) / 1.772 + 128, (r - y) / 1.402 + 128]


def coefficients(plane: np.ndarray, divisors: np.ndarray) -> np.ndarray:
    """Quantised coefficients of the blocks, in zigzag order; the image's last row and column go on to full blocks."""
    h, w = plane.shape
    p = np.pad(plane, ((0, -h % 8), (0, -w % 8)), mode="edge") - 128
    blocks = p.reshape(p.shape[0] // 8, 8, p.shape[1] // 8, 8).transpose(0, 2, 1, 3).reshape(-1, 8, 8)
    c = np.einsum("ux,nxy,vy->nuv", _COSINES, blocks, _COSINES, optimize=True).reshape(-1, 64)
    return np.rint(c / divisors).astype(np.int64)[:, ZIGZAG]


def code_lengths(counts: np.ndarray) -> dict[int, int]:
    """Lengths of a Huffman code, 16 at most, for the symbols that occur; one code more, the last, stays unused."""
    counts = counts.copy()
    while True:
        heap = [(int(n), [(s, 0)]) for s, n in enumerate(counts) if n] + [(0, [(256, 0)])]
        heapq.heapify(heap)
        while len(heap) > 1:
            (n, a), (m, b) = heapq.heappop(heap), heapq.heappop(heap)
            heapq.heappush(heap, (n + m, sorted((s, d + 1) for s, d in a + b)))
        lengths = dict(heap[0][1])
        if max(lengths.values()) <= 16:
            return lengths
        counts = np.where(counts > 0, counts // 2 + 1, 0)


def code_of(counts: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """A table's segment (numbers of codes by length, symbols), and the code and its length of each symbol."""
    order = sorted((n, s) for s, n in code_lengths(counts).items())
    code, length, value, last = np.zeros(256, np.int64), np.zeros(256, np.int64), 0, 0
    for n, s in order:
        value <<= n - last
        last = n
        if s < 256:
            code[s], length[s] = value, n
        value += 1
    real = [(n, s) for n, s in order if s < 256]
    return bytes(sum(n == k for n, _ in real) for k in range(1, 17)) + bytes(s for _, s in real), code, length


def _size(v: np.ndarray) -> np.ndarray:
    return np.ceil(np.log2(np.abs(v) + 1)).astype(np.int64)


def _symbols(blocks: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """is_dc, symbol, size and value bits of what is written, in order. blocks: of all components, one after the other."""
    n = len(blocks)
    dc = blocks[:, 0].copy()
    dc[components:] -= blocks[:-components, 0]
    row, k = np.nonzero(blocks[:, 1:])
    k = k + 1
    v = blocks[row, k]
    first = np.append(True, row[1:] != row[:-1]) if len(row) else np.zeros(0, bool)
    run = k - np.where(first, 0, np.append(0, k[:-1])) - 1
    long = np.repeat(np.arange(len(row)), run // 16)
    last = np.zeros(n, np.int64)
    np.maximum.at(last, row, k)
    open_ = np.flatnonzero(last < 63)
    size, dc_size = _size(v), _size(dc)
    parts = (  # place, is_dc, symbol, size, value
        (np.arange(n) * 132, np.ones(n, bool), dc_size, dc_size, dc),
        (row[long] * 132 + 2 * k[long], np.zeros(len(long), bool), np.full(len(long), ZEROS), np.zeros(len(long), np.int64), np.zeros(len(long), np.int64)),
        (row * 132 + 2 * k + 1, np.zeros(len(row), bool), (run % 16) * 16 + size, size, v),
        (open_ * 132 + 130, np.zeros(len(open_), bool), np.full(len(open_), END), np.zeros(len(open_), np.int64), np.zeros(len(open_), np.int64)),
    )
    place, is_dc, symbol, bits, value = (np.concatenate(c) for c in zip(*parts))
    order = np.argsort(place, kind="stable")
    return is_dc[order], symbol[order], bits[order], np.where(value < 0, value + (1 << bits) - 1, value)[order]


def _packed(values: np.ndarray, lengths: np.ndarray) -> bytes:
    """The lowest bits of each value one after the other, filled up with ones; a byte of ones is followed by a zero."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    bits = np.ones(-(-total // 8) * 8, np.uint8)
    for a in range(0, len(values), 1 << 20):
        v, n = values[a : a + (1 << 20)], lengths[a : a + (1 << 20)]
        at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        start = int(ends[a] - lengths[a])
        bits[start : start + len(at)] = (np.repeat(v, n) >> (np.repeat(n, n) - 1 - at)) & 1
    return np.packbits(bits).tobytes().replace(b"\xff", b"\xff\0")


def jpeg(image: np.ndarray, quality: int = 95) -> bytes:
    """A grey or BGR image as a JPEG file, colours at full resolution."""
    divisors = quantisation(quality)
    own = planes(image)
    blocks = np.stack([coefficients(p, divisors) for p in own], 1).reshape(-1, 64)
    is_dc, symbol, size, value = _symbols(blocks, len(own))
    tables, codes, lengths = b"", np.zeros(len(symbol), np.int64), np.zeros(len(symbol), np.int64)
    for kind, mine in ((0x00, is_dc), (0x10, ~is_dc)):
        segment, code, length = code_of(np.bincount(symbol[mine], minlength=256))
        tables += bytes([kind]) + segment
        codes[mine], lengths[mine] = code[symbol[mine]], length[symbol[mine]]
    part = lambda mark, body: b"\xff" + bytes([mark]) + struct.pack(">H", len(body) + 2) + body
    h, w = image.shape[:2]
    frame = struct.pack(">BHHB", 8, h, w, len(own)) + b"".join(bytes([k + 1, 0x11, 0]) for k in range(len(own)))
    scan = bytes([len(own)]) + b"".join(bytes([k + 1, 0]) for k in range(len(own))) + bytes([0, 63, 0])
    head = part(0xE0, b"JFIF\0\1\1\0\0\1\0\1\0\0") + part(0xDB, b"\0" + bytes(divisors[ZIGZAG].tolist())) + part(0xC0, frame) + part(0xC4, tables) + part(0xDA, scan)
    return b"\xff\xd8" + head + _packed((codes << size) | value, lengths + size) + b"\xff\xd9"
