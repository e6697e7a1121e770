"""Suffix-array dedup of repeated byte strings.

Every byte covered by a string of ``LENGTH`` bytes that also starts in a document
with a smaller id is removed. Sorting all suffixes would move the corpus fifty
times over, so the suffix array is sparse. In each window of ``LENGTH`` bytes one
suffix stands for it: of the windows' runs of ``GRAM`` bytes the one with the
least hash, the leftmost of equals. Equal windows choose the same place, so they
are found by sorting the chosen suffixes together with the bytes before them.

1. Documents are dealt into chunks. Each chunk sends a few bytes for each distinct
   hash of its chosen suffixes; those whose leading gram occurs once are done with.
2. For the others, the bytes of all windows they stand for are range-partitioned
   by the suffix's leading gram, at splitters from a sample. A gram that occurs
   very often would fill a partition: its windows travel one by one, dealt by
   content. Of equal contexts, and of equal windows, a chunk sends one.
3. Each bucket sorts its suffixes by multikey quicksort on eight bytes at a time,
   and the bytes before them likewise. Common prefixes of neighbours number all
   prefixes of a length; a window is the pair of numbers of its two sides, and the
   least document of each pair is the one that keeps it. Equal grams never lie in
   different range buckets, so none is compared across a boundary; windows dealt
   by content are whole groups as well.
4. Chunks cut out what was found.

All of it is one plan that shuffles the texts once: the chunk exchange is reused.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from larder.llm.common import text_or_empty

LENGTH = 50
GRAM = 24
CHUNK_BYTES = 8 << 20
# corpus bytes to a bucket of hashes, and to one of contexts; were all repeated, contexts would take seven times that
HASH_BYTES = 32 << 20
BUCKET_BYTES = 4 << 20
# occurrences of one gram from which its windows travel one by one
FREQUENT = 20_000
# texts, about, of which a place is sampled for the splitters
SAMPLED = 4096

_NO_ID = np.iinfo(np.int64).max
_PIECE = 1 << 20
_DOC = ["no_id", "id", "text_hash"]
_BEFORE = LENGTH - GRAM
_SAMPLE_BYTES = 256
# contexts or windows handled at once
_SLICE = 1 << 16
# stretches of documents; ``row`` is the row sent, or -1. Windows sent for themselves have rows from _WINDOWS on
_FOUND = np.dtype([("row", "<i4"), ("doc", "<i4"), ("start", "<i8"), ("end", "<i8")])
_ALIAS = np.dtype([("row", "<i4"), ("doc", "<i4"), ("shift", "<i8")])
_WINDOW = np.dtype([("row", "<i4"), ("of", "<i4"), ("doc", "<i4"), ("start", "<i8")])
_WINDOWS = 1 << 30


def _mixed(low: np.ndarray, mid: np.ndarray, high: np.ndarray) -> np.ndarray:
    """A 64-bit hash of 24 bytes, given as three numbers."""
    h = low * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    h += mid
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h += high
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(32)
    return h


def _pieces(texts: list[bytes]) -> Iterator[tuple[bytes, np.ndarray, np.ndarray]]:
    """Texts joined up to a megabyte: bytes, and document and offset of each part's first byte.

    A longer text comes in parts that overlap by all but one byte of a window.
    """
    parts, held = [], 0

    def joined():
        starts = np.cumsum([0] + [len(p) for _, _, p in parts])
        return b"".join(p for _, _, p in parts), starts, np.array([(d, o) for d, o, _ in parts], np.int64)

    for doc, text in enumerate(texts):
        for offset in range(0, max(1, len(text) - LENGTH + 1), _PIECE - LENGTH + 1):
            part = text[offset : offset + _PIECE]
            if len(part) < LENGTH:
                continue
            if held + len(part) > _PIECE:
                yield joined()
                parts, held = [], 0
            parts.append((doc, offset, part))
            held += len(part)
    if parts:
        yield joined()


def chosen(texts: list[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
    """Chosen suffixes, some at a time: (doc, hash, at, first, last) arrays.

    ``at`` is the suffix's place in the document; it stands for the windows that
    start at ``first`` to ``last``. Each window of each text is in one row.
    """
    low_bits = np.uint64(_PIECE - 1)
    for data, starts, origin in _pieces(texts):
        n = len(data)
        padded = np.frombuffer(data + bytes(8), np.uint8)
        grams = n - GRAM + 1
        words = np.ndarray((n + 1,), "<u8", padded, strides=(1,))
        hashes = _mixed(words[:grams], words[8 : 8 + grams], words[16 : 16 + grams])
        least = (hashes & ~low_bits) | np.arange(grams, dtype=np.uint64)
        width = LENGTH - GRAM + 1
        reach = 1
        while reach * 2 <= width:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        if reach < width:
            least = np.minimum(least[: reach - width], least[width - reach :])
        whole = np.ones(n - LENGTH + 1, bool)
        for end in starts[1:-1]:  # no window goes over the end of a text
            whole[max(0, end - LENGTH + 1) : end] = False
        windows = np.flatnonzero(whole)
        at = (least[windows] & low_bits).astype(np.int64)
        edge = np.flatnonzero(np.diff(at)) + 1
        begin, end = np.concatenate([[0], edge]), np.concatenate([edge, [len(at)]]) - 1
        at, first, last = at[begin], windows[begin], windows[end]
        part = np.searchsorted(starts, at, side="right") - 1
        doc, shift = origin[part, 0], origin[part, 1] - starts[part]
        yield doc, hashes[at], at + shift, first + shift, last + shift


def _routed(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and 40 more bits of each hash as one number; chosen hashes are small ones, so they are spread first."""
    h = hashes * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return (h >> np.uint64(40)) % np.uint64(buckets) << np.uint64(40) | h & np.uint64((1 << 40) - 1)


def _texts(table: pa.Table) -> tuple[pa.Table, list[bytes]]:
    """The chunk's rows in an order that does not depend on how they came."""
    table = table.sort_by([(name, "ascending") for name in _DOC])
    return table, table["bytes"].to_pylist()


def _by_bucket(buckets: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(buckets, kind="stable")
    names, starts = np.unique(buckets[order], return_index=True)
    yield from zip(names.tolist(), np.split(order, starts[1:]))


def _all_chosen(texts: list[bytes]) -> list[np.ndarray]:
    parts = list(chosen(texts))
    kinds = (np.int64, np.uint64, np.int64, np.int64, np.int64)
    return [np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, kinds[k]) for k in range(5)]


_ANNOUNCED = "bucket int, chunk int, bits binary, repeated binary, counts binary"


def _announce(buckets: int):
    """Each distinct hash of a chunk once, and how often, where that is more than once."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        _, texts = _texts(table)
        names, counts = np.unique(_routed(_all_chosen(texts)[1], buckets), return_counts=True)
        raw = names.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
        out = []
        for name, rows in _by_bucket((names >> np.uint64(40)).astype(np.int64)):
            n = counts[rows]
            out.append((name, key[0].as_py(), raw[rows].tobytes(), np.packbits(n > 1).tobytes(), n[n > 1].astype("<u4").tobytes()))
        return _table(_ANNOUNCED, out)

    return run


def _compare(frequent: int):
    """Tells each chunk which of its hashes occur again, and which are frequent."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        values, counts, sizes = [], [], []
        for row in table.select(["bits", "repeated", "counts"]).to_pylist():
            bits = np.frombuffer(row["bits"], np.uint8).reshape(-1, 5)
            wide = np.zeros((len(bits), 8), np.uint8)
            wide[:, :5] = bits
            n = np.ones(len(bits), np.int64)
            n[np.unpackbits(np.frombuffer(row["repeated"], np.uint8), count=len(n)).astype(bool)] = np.frombuffer(row["counts"], "<u4")
            values.append(wide.view("<u8").ravel())
            counts.append(n)
            sizes.append(len(n))
        values, counts = np.concatenate(values), np.concatenate(counts)
        order = np.argsort(values)
        starts = np.flatnonzero(np.concatenate([[True], np.diff(values[order]) != 0]))
        totals = np.empty(len(values), np.int64)
        totals[order] = np.repeat(np.add.reduceat(counts[order], starts), np.diff(np.append(starts, len(values))))
        parts = np.split(totals, np.cumsum(sizes)[:-1])
        again = [np.packbits(c > 1).tobytes() for c in parts]
        often = [np.packbits(c > frequent).tobytes() for c in parts]
        chunks = table["chunk"].to_pylist()
        return _table(_TOLD, list(zip(chunks, [key[0].as_py()] * len(chunks), again, often)))

    return run


_TOLD = "chunk int, bucket int, again binary, often binary"
_SENT = "bucket int, chunk int, rows binary, docs binary, ids binary, starts binary, lefts binary, sizes binary, texts binary"


def _table(schema: str, rows: list[tuple]) -> pa.Table:
    fields = [f.strip().split(" ") for f in schema.split(",")]
    columns = list(zip(*rows)) if rows else [[] for _ in fields]
    kinds = {"int": pa.int32(), "binary": pa.binary()}
    return pa.table({name: pa.array(c, kinds[kind]) for (name, kind), c in zip(fields, columns)})


def _distinct(rows: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of equally long byte rows: whether an equal one has a lesser id, and for the others the first equal one."""
    order = multikey_order(rows)
    ranked = rows[order]
    starts = np.flatnonzero(np.concatenate([[True], (ranked[1:] != ranked[:-1]).any(axis=1)]))
    sizes = np.diff(np.append(starts, len(rows)))
    least = np.empty(len(rows), np.int64)
    least[order] = np.repeat(np.minimum.reduceat(ids[order], starts), sizes)
    holder = np.where(ids == least, np.arange(len(rows)), len(rows))
    first = np.empty(len(rows), np.int64)
    first[order] = np.repeat(np.minimum.reduceat(holder[order], starts), sizes)
    return ids > least, first


def _merged(found: np.ndarray) -> np.ndarray:
    """Overlapping and touching stretches of one row and document made one; sorted."""
    found = found[np.lexsort((found["start"], found["doc"], found["row"]))]
    if len(found) < 2:
        return found
    other = np.concatenate([[True], (found["doc"][1:] != found["doc"][:-1]) | (found["row"][1:] != found["row"][:-1])])
    shift = np.cumsum(other) << 40  # keeps the running end of one document from the next
    reach = np.maximum.accumulate(found["end"] + shift)
    new = other | np.concatenate([[True], found["start"][1:] + shift[1:] > reach[:-1]])
    starts = np.flatnonzero(new)
    out = found[starts]
    out["end"] = (reach - shift)[np.append(starts[1:], len(found)) - 1]
    return out


def _aliased(found: np.ndarray, aliases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (in found, in aliases) of every pair with one ``row``; both sorted by it."""
    low = np.searchsorted(aliases["row"], found["row"], side="left")
    n = np.searchsorted(aliases["row"], found["row"], side="right") - low
    at = np.repeat(np.arange(len(found)), n)
    return at, np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)


def _rows_of(count: int, kind: np.dtype, **columns) -> np.ndarray:
    out = np.empty(count, kind)
    for name, values in columns.items():
        out[name] = values
    return out


@dataclass(frozen=True)
class Routes:
    """Ranges of grams from sampled splitters; each range is dealt over ``parts`` buckets by the whole gram."""

    splitters: np.ndarray
    parts: int

    @property
    def buckets(self) -> int:
        return (len(self.splitters) + 1) * self.parts

    def of_grams(self, grams: np.ndarray) -> np.ndarray:
        names = np.ascontiguousarray(grams).view(f"S{GRAM}").ravel()
        ranges = np.searchsorted(self.splitters, names, side="right") if len(self.splitters) else np.zeros(len(names), int)
        words = np.ascontiguousarray(grams).view("<u8")
        deal = (_mixed(words[:, 0], words[:, 1], words[:, 2]) >> np.uint64(20)) % np.uint64(self.parts)
        return ranges * self.parts + deal.astype(np.int64)

    def of_windows(self, windows: np.ndarray) -> np.ndarray:
        words = [np.ascontiguousarray(windows[:, k : k + 8]).view("<u8").ravel() for k in (0, 21, 42)]
        return ((_mixed(*words) >> np.uint64(20)) % np.uint64(self.buckets)).astype(np.int64)


class _Sender:
    """What a chunk sends, gathered a slice at a time.

    Equal contexts of a chunk are made one before anything else, in order of
    their grams so that equal ones come together: those with a lesser holder in
    the chunk are found here, of the others one is sent and the rest remembered
    as its aliases. Contexts of frequent grams are then spread into windows,
    and equal windows are made one in the same way.
    """

    def __init__(self, chunk: int, texts: list[bytes], ids: np.ndarray, routes: Routes):
        self.chunk, self.ids, self.routes = chunk, ids, routes
        self.base = np.cumsum([0] + [len(t) for t in texts])[:-1] + _BEFORE
        self.data = np.frombuffer(bytes(_BEFORE) + b"".join(texts) + bytes(LENGTH), np.uint8)
        self.sent, self.found, self.aliases, self.windows, self.next = [], [], [], [], _WINDOWS
        self.compress = zstandard.ZstdCompressor(level=1).compress

    def _bytes(self, at: np.ndarray, width: int) -> np.ndarray:
        return np.lib.stride_tricks.sliding_window_view(self.data, width)[at]

    def contexts(self, row, doc, at, first, last, often) -> None:
        k, left, size = len(row), at - first, last - first + LENGTH
        place = self.base[doc] + at
        rows = np.zeros((k, _BEFORE + LENGTH + 4), np.uint8)
        whole = self._bytes(place - _BEFORE, _BEFORE + LENGTH)
        column = np.arange(_BEFORE + LENGTH)
        inside = (column >= _BEFORE - left[:, None]) & (column < _BEFORE - left[:, None] + size[:, None])
        rows[:, : _BEFORE + LENGTH] = np.where(inside, whole, 0)
        rows[:, -4], rows[:, -3] = left, size
        gone, one = _distinct(rows, self.ids[doc])
        self.found.append(_rows_of(gone.sum(), _FOUND, row=-1, doc=doc[gone], start=first[gone], end=last[gone] + LENGTH))
        other = ~gone & (one != np.arange(k))
        same = one[other]
        self.aliases.append(_rows_of(len(same), _ALIAS, row=row[same], doc=doc[other], shift=first[other] - first[same]))
        mine = ~gone & ~other
        plain, frequent = np.flatnonzero(mine & ~often), np.flatnonzero(mine & often)
        if len(plain):
            grams = rows[plain, _BEFORE : _BEFORE + GRAM]
            texts = [whole[plain][inside[plain]]]
            self._send(self.routes.of_grams(grams), row[plain], doc[plain], first[plain], left[plain], size[plain], texts[0])
        spread = last[frequent] - first[frequent] + 1
        cuts = np.searchsorted(np.cumsum(spread), np.arange(_SLICE, spread.sum() + _SLICE, _SLICE))
        for some in np.split(frequent, np.unique(cuts)):
            if len(some):
                self._spread(row[some], doc[some], at[some], first[some], last[some])

    def _spread(self, row, doc, at, first, last) -> None:
        n = last - first + 1
        owner = np.repeat(np.arange(len(row)), n)
        start = first[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        ahead, doc_of = at[owner] - start, doc[owner]
        rows = np.zeros((len(owner), LENGTH + 6), np.uint8)
        rows[:, :LENGTH] = self._bytes(self.base[doc_of] + start, LENGTH)
        rows[:, LENGTH] = ahead
        gone, one = _distinct(rows, self.ids[doc_of])
        self.found.append(_rows_of(gone.sum(), _FOUND, row=row[owner[gone]], doc=doc_of[gone], start=start[gone], end=start[gone] + LENGTH))
        mine = np.flatnonzero(~gone & (one == np.arange(len(one))))
        number = np.zeros(len(one), np.int64)
        number[mine] = self.next + np.arange(len(mine))
        self.next += len(mine)
        kept = np.flatnonzero(~gone)
        self.windows.append(
            _rows_of(len(kept), _WINDOW, row=number[one[kept]], of=row[owner[kept]], doc=doc_of[kept], start=start[kept])
        )
        texts = rows[mine, :LENGTH]
        sizes = np.full(len(mine), LENGTH)
        self._send(self.routes.of_windows(texts), number[mine], doc_of[mine], start[mine], ahead[mine], sizes, texts.ravel())

    def _send(self, bucket, row, doc, start, left, size, texts) -> None:
        begin = np.cumsum(size) - size
        for name, some in _by_bucket(bucket):
            joined = texts[_ranges(begin[some], size[some])].tobytes()
            self.sent.append(
                (
                    name, self.chunk, row[some].astype("<i4").tobytes(), doc[some].astype("<i4").tobytes(),
                    self.ids[doc[some]].astype("<i8").tobytes(), start[some].astype("<i8").tobytes(),
                    left[some].astype(np.uint8).tobytes(), size[some].astype(np.uint8).tobytes(), self.compress(joined),
                )
            )

    def table(self) -> pa.Table:
        """With one more row, which passes through some bucket: what was found here, and the aliases."""
        found = _merged(np.concatenate(self.found)) if self.found else np.zeros(0, _FOUND)
        rest = [np.concatenate(v) if v else np.zeros(0, k) for v, k in ((self.aliases, _ALIAS), (self.windows, _WINDOW))]
        blobs = [v.tobytes() for v in (found, *rest)]
        if any(blobs):
            self.sent.append((self.chunk % self.routes.buckets, self.chunk, *blobs, None, None, None, None))
        return _table(_SENT, self.sent)


def _ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers begin[0], begin[0] + 1, ... of each range, one after the other."""
    return np.arange(size.sum()) + np.repeat(begin - (np.cumsum(size) - size), size)


def _send(buckets: int, routes: Routes):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table, told: pa.Table) -> pa.Table:
        table, texts = _texts(table)
        doc, hashes, at, first, last = _all_chosen(texts)
        names, place = np.unique(_routed(hashes, buckets), return_inverse=True)
        del hashes
        answers = {r["bucket"]: r for r in told.to_pylist()}
        again, often = np.zeros(len(names), bool), np.zeros(len(names), bool)
        for name, rows in _by_bucket((names >> np.uint64(40)).astype(np.int64)):
            again[rows] = np.unpackbits(np.frombuffer(answers[name]["again"], np.uint8), count=len(rows))
            often[rows] = np.unpackbits(np.frombuffer(answers[name]["often"], np.uint8), count=len(rows))
        rows = np.flatnonzero(again[place])
        rows = rows[np.argsort(place[rows], kind="stable")]
        ids = np.where(np.array(table["no_id"]), _NO_ID, np.array(table["id"])).astype(np.int64)
        sender = _Sender(key[0].as_py(), texts, ids, routes)
        for start in range(0, len(rows), _SLICE):
            some = rows[start : start + _SLICE]
            sender.contexts(some, doc[some], at[some], first[some], last[some], often[place[some]])
        return sender.table()

    return run


def multikey_order(rows: np.ndarray) -> np.ndarray:
    """Order of equally long byte rows, sorted by eight bytes at a time; only ties go on to the next eight."""
    n, width = rows.shape
    keys = np.zeros((n, -(-width // 8) * 8), np.uint8)
    keys[:, :width] = rows
    words = keys.view(">u8").astype(np.uint64)
    order = np.argsort(words[:, 0])
    tied = np.concatenate([[False], words[order[1:], 0] == words[order[:-1], 0]])
    for depth in range(1, words.shape[1]):
        member = tied | np.concatenate([tied[1:], [False]])
        places = np.flatnonzero(member)
        if not len(places):
            break
        some = order[places]
        group = np.cumsum(~tied)[places]
        order[places] = some[np.lexsort((words[some, depth], group))]
        tied[1:] &= words[order[1:], depth] == words[order[:-1], depth]
    return order


def _numbers(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted order of the rows, and the common prefix of each with the row before it (-1 for the first)."""
    order = multikey_order(rows)
    ranked = rows[order]
    differ = ranked[1:] != ranked[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    return order, np.concatenate([[-1], common])


def kept_by_another(texts: np.ndarray, begins, lefts, sizes, ids) -> tuple[np.ndarray, np.ndarray]:
    """For rows of bytes around a suffix: the most and the fewest bytes before it of windows found in a lesser document.

    Row k is ``texts[begins[k] : begins[k] + sizes[k]]`` with its suffix at
    ``lefts[k]``; it stands for the windows that lie in it. -1 where none is found.
    """
    n, before = len(begins), LENGTH - GRAM
    padded = np.concatenate([np.zeros(before, np.uint8), texts, np.zeros(LENGTH, np.uint8)])
    suffix = np.lib.stride_tricks.sliding_window_view(padded, LENGTH)[begins + lefts + before].copy()
    suffix[np.arange(LENGTH) >= (sizes - lefts)[:, None]] = 0
    prefix = np.lib.stride_tricks.sliding_window_view(padded, before)[begins + lefts][:, ::-1].copy()
    prefix[np.arange(before) >= lefts[:, None]] = 0
    right_order, right_common = _numbers(suffix)
    left_order, left_common = _numbers(prefix)
    most, fewest = np.full(n, -1), np.full(n, -1)
    right, left = np.empty(n, np.int64), np.empty(n, np.int64)
    shortest = LENGTH - (sizes - lefts)
    for ahead in range(before + 1):
        rows = np.flatnonzero((shortest <= ahead) & (ahead <= lefts))
        if len(rows) < 2:
            continue
        right[right_order] = np.cumsum(right_common < LENGTH - ahead)
        left[left_order] = np.cumsum(left_common < ahead)
        pair = right[rows] * (n + 1) + left[rows]
        order = np.argsort(pair, kind="stable")
        ranked = pair[order]
        starts = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
        least = np.minimum.reduceat(ids[rows][order], starts)
        holder = np.empty(len(rows), np.int64)
        holder[order] = np.repeat(least, np.diff(np.append(starts, len(rows))))
        hit = rows[ids[rows] > holder]
        most[hit] = ahead
        fewest[hit] = np.where(fewest[hit] < 0, ahead, fewest[hit])
    return most, fewest


_ANSWERED = "chunk int, found binary, aliases binary, windows binary"


def _sort_bucket(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    out = []
    parts = {name: [] for name in ("chunk", "rows", "docs", "ids", "starts", "lefts", "sizes", "texts")}
    unpack = zstandard.ZstdDecompressor().decompress
    for row in table.to_pylist():
        if row["texts"] is None:
            out.append((row["chunk"], row["rows"], row["docs"], row["ids"]))
            continue
        docs = np.frombuffer(row["docs"], "<i4")
        parts["chunk"].append(np.full(len(docs), row["chunk"], np.int32))
        parts["rows"].append(np.frombuffer(row["rows"], "<i4"))
        parts["docs"].append(docs)
        parts["ids"].append(np.frombuffer(row["ids"], "<i8"))
        parts["starts"].append(np.frombuffer(row["starts"], "<i8"))
        parts["lefts"].append(np.frombuffer(row["lefts"], np.uint8).astype(np.int64))
        parts["sizes"].append(np.frombuffer(row["sizes"], np.uint8).astype(np.int64))
        parts["texts"].append(np.frombuffer(unpack(row["texts"]), np.uint8))
    if parts["docs"]:
        chunk, number, doc, ids, start, left, size, text = (np.concatenate(v) for v in parts.values())
        parts.clear()
        most, fewest = kept_by_another(text, np.cumsum(size) - size, left, size, ids)
        hit = np.flatnonzero(most >= 0)
        suffix = start[hit] + left[hit]
        found = _rows_of(
            len(hit), _FOUND, row=number[hit], doc=doc[hit], start=suffix - most[hit], end=suffix - fewest[hit] + LENGTH
        )
        out += [(name, found[rows].tobytes(), None, None) for name, rows in _by_bucket(chunk[hit])]
    return _table(_ANSWERED, out)


def _resolved(found: pa.Table) -> np.ndarray:
    """Stretches of documents that go: what was found of rows sent holds for all their aliases."""
    blobs = [b"".join(b for b in found[c].to_pylist() if b) for c in ("found", "aliases", "windows")]
    rows, aliases, windows = (np.frombuffer(b, k) for b, k in zip(blobs, (_FOUND, _ALIAS, _WINDOW)))
    of_window = rows["row"] >= _WINDOWS
    windows = windows[np.argsort(windows["row"], kind="stable")]
    _, at = _aliased(rows[of_window], windows)
    w = windows[at]
    spread = _rows_of(len(w), _FOUND, row=w["of"], doc=w["doc"], start=w["start"], end=w["start"] + LENGTH)
    rows = _merged(np.concatenate([rows[~of_window], spread]))
    aliases = aliases[np.argsort(aliases["row"], kind="stable")]
    at, of = _aliased(rows, aliases)
    a = aliases[of]
    more = _rows_of(len(a), _FOUND, doc=a["doc"], start=rows["start"][at] + a["shift"], end=rows["end"][at] + a["shift"])
    rows = np.concatenate([rows, more])
    rows["row"] = 0
    return _merged(rows)


_CUT = "no_id boolean, id bigint, n_bytes bigint, spans array<struct<start: bigint, end: bigint>>, kept binary"


def _cut(key: tuple[pa.Scalar, ...], table: pa.Table, found: pa.Table) -> pa.Table:
    table, texts = _texts(table)
    rows = _resolved(found)
    edges = np.searchsorted(rows["doc"], np.arange(len(texts) + 1))
    spans, kept = [], []
    for k, text in enumerate(texts):
        own, rest, at = rows[edges[k] : edges[k + 1]], [], 0
        merged = [{"start": a, "end": b} for a, b in zip(own["start"].tolist(), own["end"].tolist())]
        for span in merged:
            rest.append(text[at : span["start"]])
            at = span["end"]
        spans.append(merged)
        kept.append(b"".join([*rest, text[at:]]) if merged else text)
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    return pa.table(
        {
            "no_id": table["no_id"].combine_chunks(),
            "id": table["id"].combine_chunks(),
            "n_bytes": pa.array([len(t) for t in texts], pa.int64()),
            "spans": pa.array(spans, span_type),
            "kept": pa.array(kept, pa.binary()),
        }
    )


def _sampled_grams(pieces: list[bytes]) -> np.ndarray:
    """The gram of the first chosen suffix of each piece, sorted."""
    grams = []
    for piece in pieces:
        for _, _, at, _, _ in chosen([piece]):
            grams.append(piece[at[0] : at[0] + GRAM])
    return np.sort(np.array(grams, f"S{GRAM}"))


def without_repeats(
    docs: DataFrame,
    chunk_bytes: int = CHUNK_BYTES,
    bucket_bytes: int = BUCKET_BYTES,
    frequent: int = FREQUENT,
    hash_bytes: int = HASH_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, spans (removed bytes, ``end`` exclusive), kept (binary).

    Strings are compared within and across whole texts as UTF-8, never across two
    documents, and judged on the input. A null text is empty. Documents without
    id count as greater than all others and equal to each other; rows that share
    an id are not smaller than each other, so neither loses what only they hold.
    Texts shorter than ``LENGTH`` are kept. An empty table gives no rows.
    """
    text = text_or_empty()
    rows = docs.select(
        F.col("doc_id").isNull().alias("no_id"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)).alias("id"),
        F.xxhash64(text, F.octet_length(text)).alias("text_hash"),
        text.cast("binary").alias("bytes"),
    )
    size = F.octet_length("bytes")
    total, texts = rows.agg(F.coalesce(F.sum(size), F.lit(0)), F.count("*")).first()
    # a few bytes at one place of some texts; a text that is repeated counts once
    place = F.pmod(F.xxhash64("text_hash"), F.greatest(size - _SAMPLE_BYTES, F.lit(1)).cast("bigint")) + 1
    sampled = (
        rows.where(F.pmod("text_hash", F.lit(max(1, texts))) < SAMPLED)
        .select("text_hash", F.expr("bytes").substr(place.cast("int"), F.lit(_SAMPLE_BYTES)).alias("piece"))
        .distinct()
        .collect()
    )
    chunks, hashed, buckets = total // chunk_bytes + 1, total // hash_bytes + 1, total // bucket_bytes + 1
    grams = _sampled_grams([bytes(r.piece) for r in sampled])
    ranges = max(min(buckets, len(grams) // 4), 1)
    routes = Routes(np.unique(grams[(np.arange(1, ranges) * len(grams)) // ranges]), -(-buckets // ranges))

    dealt = rows.withColumn("chunk", F.pmod(F.xxhash64(*_DOC), F.lit(chunks)).cast("int"))
    announced = dealt.groupBy("chunk").applyInArrow(_announce(hashed), _ANNOUNCED)
    told = announced.groupBy("bucket").applyInArrow(_compare(frequent), _TOLD)
    sent = dealt.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(_send(hashed, routes), _SENT)
    found = sent.groupBy("bucket").applyInArrow(_sort_bucket, _ANSWERED)
    cut = dealt.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(_cut, _CUT)
    return cut.select(F.expr("if(no_id, null, id)").alias("doc_id"), "n_bytes", "spans", "kept")
