"""Token ids of documents in wavelet matrix files, one per shard.

Documents are range-partitioned by id and sorted; each partition writes shards
of about ``SHARD_TOKENS`` ids, whole documents only. A shard is one file: its
bytes go through Spark's text writer as a single row per file, so that files of
lost or repeated tasks never become visible, whatever store the folder is in.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from unicodedata import normalize

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from larder.llm.common import stored
from larder.llm.wavelet import WaveletFile, build
from larder.session import scratch_folder

END = 1
SHARD_TOKENS = 1 << 20
# words whose ids a worker remembers, in two halves: a full half takes the place of the older one
REMEMBERED = 600_000
# words given to the tokenizer at once; it takes some thousand bytes for each
TOGETHER = 1 << 11

# punctuation that is in no special token and in no contraction
_CLOSING = b"!\"#$%&()*+,-./:;=?@[]^_`{}~\\"
_PROBE = "Ab, cd.\tEf!!\n gh?). don't.\x0b\x0cij \r1, 2. É, é.;"
_PLAIN = "a i s t re ve the dont people zyxw qqqq internationalisation abcdefghijklmnopqrstuvwxyz"
# small letters that are single code points whether composed or not, and are their own lower case
_SMALL = [chr(c) for c in (*range(97, 123), *range(0xDF, 0x100)) if c != 0xF7]
_SMALL_WORD = re.compile(f"[{''.join(_SMALL)}]+")
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


class WordEncoder:
    """Ids of white-space separated words, as packed bytes; remembers those of words and of their parts.

    The tokenizer never joins text across ASCII white space, so a text's ids are
    its words' ids in order. ASCII punctuation at the end of a word, after a
    letter or digit, is a piece of its own and is looked up apart from the rest.
    Both rest on how the tokenizer cuts a text before its merges;
    ``split_safe`` checks for that. Words of small Latin letters alone are one
    piece each and go to the tokenizer's merges directly, in the ``letters`` that
    its pre-tokenizer writes them in, where ``direct`` shows that this gives the
    same ids.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.recent: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.merges = self.tokenizer.model
        self.size = self.tokenizer.get_vocab_size()
        self.kind = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        everything = np.arange(self.size, dtype=self.kind).tobytes()
        self.single = [everything[i : i + self.kind.itemsize] for i in range(0, len(everything), self.kind.itemsize)]
        self.split_safe, self.folds = self._is_split_safe(_PROBE), self._ids(_PROBE) == self._ids(_PROBE.lower())
        cut = self.tokenizer.pre_tokenizer
        self.letters = {ord(c): cut.pre_tokenize_str(c)[0][0] if cut else c for c in _SMALL}
        probes = [*_PLAIN.split(), *(f"a{c}{d}e" for c, d in zip(_SMALL, _SMALL[7:] + _SMALL)), *_SMALL, "".join(_SMALL)]
        self.direct = all(self._ids(w) == [t.id for t in self._pieces(w)] for w in probes)

    def _is_split_safe(self, probe: str) -> bool:
        pieces = [p for word in probe.split() for p in self._parted(word.encode()) if p]
        return self._ids(probe) == [i for piece in pieces for i in self._ids(piece.decode())]

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _pieces(self, word: str) -> list:
        return self.merges.tokenize(word if word.isascii() else word.translate(self.letters))

    @staticmethod
    def _parted(word: bytes) -> tuple[bytes, bytes]:
        """A word and the punctuation at its end, which is left with the word where they might belong together."""
        core = word.rstrip(_CLOSING)
        if not core or len(core) == len(word):
            return word, b""
        # the tokenizer composes and lowers first; a letter can then end in a mark, which joins what follows
        last = core[-1:] if core[-1] < 128 else normalize("NFC", core.decode()).lower()[-1:]
        return (core, word[len(core) :]) if last.isalnum() else (word, b"")

    def _merged(self, words: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        """Each of ``words`` with the ids the tokenizer gives it by itself."""
        joined, rest = [], []
        small, single, pieces, direct = _SMALL_WORD.fullmatch, self.single, self._pieces, self.direct
        for word in words:
            text = word.decode()
            if direct and small(text):
                yield word, b"".join([single[t.id] for t in pieces(text)])
            else:
                (joined if text.isalpha() and len(text) < 64 else rest).append(text)
        for start in range(0, len(joined), TOGETHER):
            some = joined[start : start + TOGETHER]
            encoding = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            ids, owner = np.array(encoding.ids, self.kind), np.array(encoding.word_ids, np.int64)
            cuts = np.flatnonzero(np.diff(owner)) + 1
            if len(cuts) + 1 == len(some):  # one piece a word, as expected of letters
                size = self.kind.itemsize
                packed, edges = ids.tobytes(), [0, *(cuts * size).tolist(), len(ids) * size]
                for word, a, b in zip(some, edges, edges[1:]):
                    yield word.encode(), packed[a:b]
            else:
                rest += some
        for start in range(0, len(rest), TOGETHER):
            some = rest[start : start + TOGETHER]
            for word, encoding in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False)):
                yield word.encode(), np.array(encoding.ids, self.kind).tobytes()

    def known(self, words: Iterable[bytes]) -> dict[bytes, bytes]:
        """A mapping with the ids of each of ``words``, no two alike; those not seen lately go to the tokenizer."""
        if len(self.recent) > REMEMBERED // 2:
            self.older, self.recent = self.recent, {}
        recent, older = self.recent, self.older
        parted, parts = [], set()
        for word in words:
            if word in recent:
                continue
            if (ids := older.get(word)) is not None:
                recent[word] = ids
                continue
            core, stop = (word, b"") if word.isalpha() else self._parted(word)
            parts.add(core)
            if stop:
                parts.add(stop)
                parted.append((word, core, stop))
        new = []
        for part in parts:
            if part not in recent:
                if (ids := older.get(part)) is not None:
                    recent[part] = ids
                else:
                    new.append(part)
        recent.update(self._merged(new))
        for word, core, stop in parted:
            recent[word] = recent[core] + recent[stop]
        return recent

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text."""
        if not self.split_safe:
            return [np.array(self._ids(text), self.kind).tobytes() for text in texts]
        raws = []
        for text in texts:
            raw = text.encode()
            # upper case may be folded unless it could join a combining mark or spell a special token
            if self.folds and b"<|" not in raw and b"\xcc" not in raw and b"\xcd" not in raw:
                raw = raw.translate(_LOWER)
            raws.append(raw)
        # the empty words at the ends of a text have no ids
        split = pc.ascii_split_whitespace(pa.array(raws, pa.large_string()))
        words = split.flatten().dictionary_encode()
        distinct = words.dictionary.cast(pa.large_binary()).to_pylist()
        ids = self.known(word for word in distinct if word)
        packed = pa.array([ids[word] if word else b"" for word in distinct], pa.large_binary()).take(words.indices)
        _, offsets, data = packed.buffers()
        edges = np.frombuffer(offsets, np.int64)[split.offsets.to_numpy()].tolist()
        data = data.to_pybytes() if data else b""
        return [data[a:b] for a, b in zip(edges, edges[1:])]


@lru_cache(maxsize=2)
def _encoder(path: str) -> WordEncoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    return WordEncoder(path)


def _pieces(batches: Iterator[pa.RecordBatch], most: int = 8 << 20) -> Iterator[tuple[list, list]]:
    """Ids and texts of some documents at a time, about ``most`` characters."""
    for batch in batches:
        names, texts, held = [], [], 0
        for name, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
            names.append(name)
            texts.append(text.as_py() or "")
            held += len(texts[-1])
            if held >= most:
                yield names, texts
                names, texts, held = [], [], 0
        if names:
            yield names, texts


def _shards(path: str, end: int, shard_tokens: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        part, sequence, first = TaskContext.get().partitionId(), 0, 0
        names, packed, held = [], [], 0
        stop = np.array([end], encoder.kind).tobytes()
        width = max(encoder.size - 1, end).bit_length()

        def shard():
            ids = np.frombuffer(b"".join(packed), encoder.kind)
            ends = np.cumsum([len(p) // encoder.kind.itemsize for p in packed])
            data = build(ids, names, ends, width, {"part": part, "sequence": sequence, "first": first})
            return pa.RecordBatch.from_pydict({"value": pa.array([data], pa.binary())})

        for some, texts in _pieces(batches):
            for name, ids in zip(some, encoder.encode_all(texts)):
                names.append(name)
                packed.append(ids + stop)
                held += len(packed[-1]) // encoder.kind.itemsize
                if held >= shard_tokens:
                    yield shard()
                    names, packed, first, sequence, held = [], [], first + held, sequence + 1, 0
        if names:
            yield shard()

    return write


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch["content"]:
            file = WaveletFile(content.as_py())
            ids = file.tokens().astype("<u4")
            starts = np.concatenate([[0], file.ends[:-1]]).astype(np.int64)
            n = len(starts)
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([file.about["part"]] * n, pa.int32()),
                    "doc_id": pa.array(file.doc_ids, pa.int64()),
                    "start": pa.array(starts + file.about["first"], pa.int64()),
                    "n_tokens": pa.array(file.ends - starts, pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(ids[a:b]) for a, b in zip(starts, file.ends)], pa.int64()),
                }
            )


def write_shards(docs: DataFrame, folder: str, tokenizer: str, end: int = END, shard_tokens: int = SHARD_TOKENS) -> None:
    """Write the token ids of ``docs`` (``doc_id``, ``text``) as wavelet matrix files to a new folder.

    Each document is its whole text's ids and the id ``end``. A null text counts
    as empty. Documents without an id come first; rows that share an id follow
    each other in the order of their texts. An empty table writes no shard. A
    document longer than ``shard_tokens`` makes a longer shard.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    shards = ordered.mapInArrow(_shards(tokenizer, end, shard_tokens), "value binary")
    # a binary value cast to text keeps its bytes
    shards.select(F.col("value").cast("string")).write.option("maxRecordsPerFile", 1).text(folder)


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document of the shards: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it. The running sum goes
    over partitions, of which each gives one row.
    """
    files = spark.read.format("binaryFile").schema(
        "path string, modificationTime timestamp, length long, content binary"
    ).load(folder)
    schema = "part int, doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    rows = stored(files.select("content").mapInArrow(_documents, schema), "token-documents")
    parts = rows.groupBy("part").agg(F.sum("n_tokens").alias("held"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("part", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("offset"))
    return rows.join(offsets, "part").select(
        "doc_id", (F.col("start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"
    )


def round_trip(docs: DataFrame, tokenizer: str, end: int = END) -> DataFrame:
    """Write ``docs`` as shards into the shared folder and read them back."""
    folder = scratch_folder(docs.sparkSession, "tokens")
    write_shards(docs, folder, tokenizer, end)
    return read_documents(docs.sparkSession, folder)
