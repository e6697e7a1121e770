"""Wavelet matrix of a sequence of token ids, in one compressed file.

The ids are written bit by bit, highest bit first. Under each plane the ids are
parted by its bit, zeros before ones, each side in its old order; the next plane
holds the next bit in that order. Planes are cut into blocks of ``BLOCK`` bits,
each compressed by itself, and a directory has the place of each block and the
number of ones before it. A point access decompresses one block per plane.

File: ``MAGIC``, the length of the header (u32), the header (JSON), then the
sections the header lists by offset and length: document ids, document ends,
directory, blocks. All numbers are little-endian. Bytes after the last section
are ignored.
"""

from __future__ import annotations

import json
import struct

import numpy as np
import zstandard

MAGIC = b"WVLTMX01"
BLOCK = 1 << 16
_BYTES = BLOCK // 8


def _bits(packed: np.ndarray, n: int) -> np.ndarray:
    return np.unpackbits(packed, count=n).view(bool)


def build(ids: np.ndarray, doc_ids: list[int | None], ends: np.ndarray, width: int, about: dict) -> bytes:
    """The file for ``ids``; document k has the ids before ``ends[k]`` from the end before."""
    compress = zstandard.ZstdCompressor(level=1).compress
    n = len(ids)
    order = ids.astype(np.uint16 if width <= 16 else np.uint32)
    blocks, places, ones_before, zeros = [], [], [], []
    place = 0
    for bit in range(width - 1, -1, -1):
        plane = ((order >> order.dtype.type(bit)) & order.dtype.type(1)).astype(bool)
        packed = np.packbits(plane)
        ones = 0
        for start in range(0, len(packed), _BYTES):
            piece = packed[start : start + _BYTES]
            block = compress(piece.tobytes())
            blocks.append(block)
            places.append(place)
            ones_before.append(ones)
            place += len(block)
            ones += int(np.bitwise_count(piece).sum())
        zeros.append(n - ones)
        order = np.concatenate([np.compress(~plane, order), np.compress(plane, order)])
    places.append(place)
    known = np.array([d is not None for d in doc_ids], bool)
    names = np.array([d if d is not None else 0 for d in doc_ids], "<i8")
    sections = {
        "known": compress(np.packbits(known).tobytes()),
        "names": compress(np.diff(names, prepend=0).astype("<i8").tobytes()),
        "ends": compress(np.asarray(ends, "<u8").tobytes()),
        "places": compress(np.asarray(places, "<u8").tobytes()),
        "ones": compress(np.asarray(ones_before, "<u4").tobytes()),
        "blocks": b"".join(blocks),
    }
    header = about | {"n": n, "docs": len(doc_ids), "width": width, "zeros": zeros, "sections": {}}
    offset = 0
    for name, data in sections.items():
        header["sections"][name] = [offset, len(data)]
        offset += len(data)
    head = json.dumps(header).encode()
    return b"".join([MAGIC, struct.pack("<I", len(head)), head, *sections.values()])


class WaveletFile:
    """Queries on one file's bytes; positions and counts are within the file."""

    def __init__(self, data: bytes):
        if data[: len(MAGIC)] != MAGIC:
            raise ValueError("not a wavelet matrix file")
        (length,) = struct.unpack_from("<I", data, len(MAGIC))
        start = len(MAGIC) + 4
        self.about = json.loads(bytes(data[start : start + length]))
        self._data = memoryview(data)[start + length :]
        self.n, self.width, self.zeros = self.about["n"], self.about["width"], self.about["zeros"]
        self._unpack = zstandard.ZstdDecompressor().decompress
        self.ends = np.frombuffer(self._section("ends"), "<u8").astype(np.int64)
        known = np.unpackbits(np.frombuffer(self._section("known"), np.uint8), count=self.about["docs"])
        names = np.cumsum(np.frombuffer(self._section("names"), "<i8"))
        self.doc_ids = [int(x) if k else None for x, k in zip(names, known)]
        self._places = np.frombuffer(self._section("places"), "<u8").astype(np.int64)
        self._ones = np.frombuffer(self._section("ones"), "<u4").astype(np.int64)
        self._blocks = self._raw("blocks")
        self._per_plane = -(-self.n // BLOCK)

    def _raw(self, name: str) -> memoryview:
        offset, length = self.about["sections"][name]
        return self._data[offset : offset + length]

    def _section(self, name: str) -> bytes:
        return self._unpack(self._raw(name))

    def _block(self, plane: int, block: int) -> np.ndarray:
        k = plane * self._per_plane + block
        return np.frombuffer(self._unpack(self._blocks[self._places[k] : self._places[k + 1]]), np.uint8)

    def _plane(self, plane: int) -> np.ndarray:
        parts = [self._block(plane, b) for b in range(self._per_plane)]
        return _bits(np.concatenate(parts), self.n) if parts else np.zeros(0, bool)

    def _rank1(self, plane: int, i: int) -> tuple[int, int]:
        """Ones before position i of a plane, and the bit there (0 at the end)."""
        if i >= self.n:
            return self.n - self.zeros[plane], 0
        block, inside = divmod(i, BLOCK)
        packed = self._block(plane, block)
        whole, rest = divmod(inside, 8)
        ones = int(self._ones[plane * self._per_plane + block]) + int(np.bitwise_count(packed[:whole]).sum())
        last = int(packed[whole])
        return ones + (last >> (8 - rest)).bit_count(), (last >> (7 - rest)) & 1

    def _select(self, plane: int, bit: int, k: int) -> int:
        """Position of the k-th (from 0) bit of this value in a plane."""
        first = plane * self._per_plane
        before = self._ones[first : first + self._per_plane]
        if not bit:
            before = np.arange(self._per_plane) * BLOCK - before
        block = int(np.searchsorted(before, k, side="right")) - 1
        bits = _bits(self._block(plane, block), min(BLOCK, self.n - block * BLOCK))
        return block * BLOCK + int(np.flatnonzero(bits == bool(bit))[k - int(before[block])])

    def access(self, i: int) -> int:
        """The token at position i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        token = 0
        for plane in range(self.width):
            ones, bit = self._rank1(plane, i)
            token = token << 1 | bit
            i = self.zeros[plane] + ones if bit else i - ones
        return token

    def _interval(self, token: int, start: int, end: int) -> tuple[int, int]:
        """Where the token's occurrences among positions start to end lie below the last plane."""
        if token >> self.width:
            return 0, 0
        for plane in range(self.width):
            low, high = self._rank1(plane, start)[0], self._rank1(plane, end)[0]
            if token >> (self.width - 1 - plane) & 1:
                start, end = self.zeros[plane] + low, self.zeros[plane] + high
            else:
                start, end = start - low, end - high
        return start, end

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        """How often the token occurs at positions start to end (exclusive)."""
        low, high = self._interval(token, start, self.n if end is None else min(end, self.n))
        return max(0, high - low)

    def locate(self, token: int, k: int) -> int:
        """Position of the token's k-th occurrence, counted from 0."""
        low, high = self._interval(token, 0, self.n)
        if not 0 <= k < high - low:
            raise IndexError(k)
        i = low + k
        for plane in range(self.width - 1, -1, -1):
            bit = token >> (self.width - 1 - plane) & 1
            i = self._select(plane, bit, i - self.zeros[plane] if bit else i)
        return i

    def occurrences(self, token: int) -> list[int]:
        return [self.locate(token, k) for k in range(self.count(token))]

    def tokens(self) -> np.ndarray:
        """All ids, from the last plane upwards."""
        values = np.zeros(self.n, np.uint16 if self.width <= 16 else np.uint32)
        for plane in range(self.width - 1, -1, -1):
            bits = self._plane(plane)
            upper = np.empty_like(values)
            zeros = self.zeros[plane]
            upper[np.flatnonzero(~bits)] = values[:zeros]
            upper[np.flatnonzero(bits)] = values[zeros:] | values.dtype.type(1 << (self.width - 1 - plane))
            values = upper
        return values
