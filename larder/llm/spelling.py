"""Spelling variants: words one edit from a far more frequent word.

Near words differ by exactly one inserted, deleted or replaced code point. That
holds if their common prefix and common suffix together reach the longer length
less one. Tiles compare words densely: the code points of a block of words are
two padded matrices, aligned left and right, and one column after the other of
block against block gives all prefix and suffix lengths.

Which blocks meet is decided by keys. If the longer of two near words has m code
points, one edit leaves enough of the prefix or of the suffix, and of the half
that it lies in enough of one side again. So near words share at least one of
four keys of about 3/4 m code points (``_SIDES``), and every word is filed under
four keys for m of its length and four for one more. A pair that shares several
keys is taken from the first. A key with more than ``TILE`` words is cut into
blocks whose pairs are tiles of their own.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from larder.llm.common import dropped, stored, text_or_empty

LEAST_LENGTH = 7
LEAST_COUNT = 2
# a form is at least so many times as frequent as its variant
TIMES = 10
# words of a block
TILE = 256

# code points that a word is made of; all fit one byte
LETTERS = "A-Za-zÀ-ÿ"
# a task's counts go out when it holds so many words
HELD = 200_000
# bytes of a padded matrix
_MATRIX = 8 << 20

_FOLD = str.maketrans({c: chr(c + 32) for c in range(65, 91)})


def _counter(edit: Callable[[str], Callable[[str], str]] | None, least: int):
    pattern = re.compile(f"[{LETTERS}]{{{least},}}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counter()

        def out():
            columns = {"word": pa.array(list(counts), pa.string()), "n": pa.array(list(counts.values()), pa.int64())}
            counts.clear()
            return pa.RecordBatch.from_pydict(columns)

        for batch in batches:
            for name, text in zip(batch["doc_id"], batch["text"]):
                runs = Counter(pattern.findall(text.as_py().translate(_FOLD)))
                if edit:
                    changed = edit(name.as_py())
                    for word, n in runs.items():
                        counts[changed(word)] += n
                else:
                    counts.update(runs)
                if len(counts) > HELD:
                    yield out()
        yield out()

    return run


def word_counts(
    docs: DataFrame,
    edit: Callable[[str], Callable[[str], str]] | None = None,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
) -> DataFrame:
    """(word, n): the words of ``docs`` (``doc_id``, ``text``) and how often they occur.

    Words are maximal runs of ``LETTERS``, A to Z in lower case, of at least
    ``least_length`` code points. ``edit``, given a document's id as text, gives
    a function that is applied to each of the document's runs of that length; it
    may make them shorter.
    """
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), text_or_empty().alias("text"))
    partial = rows.mapInArrow(_counter(edit, least_length), "word string, n bigint")
    whole = partial.where(F.char_length("word") >= least_length).groupBy("word").agg(F.sum("n").alias("n"))
    return whole.where(F.col("n") >= least_count)


def _sides(m: int) -> list[tuple[int, int]]:
    """Of two near words, the longer of m code points: lengths (prefix, suffix), one of which both share whole."""
    a = (m + 1) // 2
    b = m - a
    a_more, b_more = (b + 1) // 2, (a + 1) // 2
    return [(a + a_more, 0), (a, b - a_more), (0, b + b_more), (a - b_more, b)]


def _keys(words: DataFrame) -> DataFrame:
    """(key, m, side, word, n): each word once for every key it is filed under."""
    a, b = "int((m + 1) div 2)", "int(m div 2)"
    lengths = [
        (f"{a} + int(({b} + 1) div 2)", "0"),
        (a, f"{b} - int(({b} + 1) div 2)"),
        ("0", f"{b} + int(({a} + 1) div 2)"),
        (f"{a} - int(({a} + 1) div 2)", b),
    ]
    keys = [
        f"struct({side} AS side, m, concat_ws('|', {side}, m, left(word, {p}), right(word, {s})) AS key)"
        for side, (p, s) in enumerate(lengths)
    ]
    of_m = words.select("word", "n", F.explode(F.array(F.char_length("word"), F.char_length("word") + 1)).alias("m"))
    return of_m.select("word", "n", F.expr(f"explode(array({', '.join(keys)})) AS k")).select("k.key", "k.m", "k.side", "word", "n")


def _matrices(words: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    left = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(len(words), width)
    right = np.frombuffer(b"".join(w.rjust(width, b"\0") for w in words), np.uint8).reshape(len(words), width)
    return left, right[:, ::-1]


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many columns from the first on agree, for every row of ``a`` and every row of ``b``."""
    agree = np.ones((len(a), len(b)), bool)
    length = np.zeros((len(a), len(b)), np.int32)
    for column in range(a.shape[1]):
        agree &= a[:, column, None] == b[None, :, column]
        if not agree.any():
            break
        length += agree
    return length


def near_in_tile(a: list[bytes], b: list[bytes], same_key: np.ndarray, m: np.ndarray, side: np.ndarray):
    """Places (in a, in b) of near words; ``same_key`` says which may meet, ``m`` and ``side`` name the key of a's words."""
    size_a, size_b = np.array([len(w) for w in a]), np.array([len(w) for w in b])
    width = int(max(size_a.max(), size_b.max()))
    left_a, right_a = _matrices(a, width)
    left_b, right_b = _matrices(b, width)
    shorter = np.minimum(size_a[:, None], size_b[None, :])
    longer = np.maximum(size_a[:, None], size_b[None, :])
    meet = same_key & (longer == m[:, None])
    prefix = np.minimum(_common(left_a, left_b), shorter)
    suffix = np.minimum(_common(right_a, right_b), shorter)
    at_a, at_b = np.nonzero(meet & (prefix + suffix >= longer - 1) & (prefix < longer))
    # the same pair meets under every key it shares; the first of them counts
    kept = []
    for i, j in zip(at_a.tolist(), at_b.tolist()):
        p, s = prefix[i, j], suffix[i, j]
        kept.append(next(k for k, (x, y) in enumerate(_sides(int(m[i]))) if p >= x and s >= y) == side[i])
    return at_a[kept], at_b[kept]


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words, both ways, of rows sorted by tile."""
    block, width = [], 0  # rows of whole tiles: (tile, first, m, side, word, n)
    tile = []

    def pairs(rows):
        group = np.cumsum([0] + [x[0] != y[0] for x, y in zip(rows, rows[1:])])
        of = np.array([r[1] for r in rows])
        m, side = np.array([r[2] for r in rows]), np.array([r[3] for r in rows])
        words = [r[4].encode("latin-1") for r in rows]
        # of a tile of two blocks only pairs across, of one block each pair once
        step = max(_MATRIX // max(map(len, words)), 2)
        found = []
        for i in range(0, len(rows), step):
            for j in range(i, len(rows), step):
                x, y = slice(i, i + step), slice(j, j + step)
                meet = group[x, None] == group[None, y]
                meet &= (of[x, None] < 0) | (of[x, None] != of[None, y])
                meet &= np.arange(len(rows))[x, None] < np.arange(len(rows))[None, y]
                at_a, at_b = near_in_tile(words[x], words[y], meet, m[x], side[x])
                found += zip((at_a + i).tolist(), (at_b + j).tolist())
        both = [(rows[p][4], rows[q][4], rows[q][5]) for a, b in found for p, q in ((a, b), (b, a))]
        columns = list(zip(*both)) if both else ([], [], [])
        kinds = {"word": pa.string(), "near": pa.string(), "near_n": pa.int64()}
        return pa.RecordBatch.from_pydict({k: pa.array(c, t) for (k, t), c in zip(kinds.items(), columns)})

    def ended():
        """The tile joins the block, unless it is a single word; whether the block is full."""
        nonlocal width
        if len(tile) > 1:
            block.extend(tile)
            width = max(width, max(len(r[4]) for r in tile))
        tile.clear()
        return len(block) >= TILE or len(block) * width > _MATRIX

    for batch in batches:
        columns = [batch[name].to_pylist() for name in ("tile", "first", "m", "side", "word", "n")]
        for row in zip(*columns):
            if tile and tile[0][0] != row[0] and ended():
                yield pairs(block)
                block, width = [], 0
            tile.append(row)
    ended()
    if block:
        yield pairs(block)


def near_words(words: DataFrame, tile: int = TILE) -> DataFrame:
    """(word, near, near_n): every ordered pair of near words of ``words`` (``word``, ``n``), once."""
    keys = _keys(words)
    crowded = keys.groupBy("key").agg(F.count("*").alias("held")).where(F.col("held") > tile)
    crowded = stored(crowded.select("key", F.ceil(F.col("held") / tile).cast("int").alias("blocks")), "crowded-keys")
    spread = keys.join(crowded, "key", "left")
    own = F.expr("int(pmod(xxhash64(word), blocks))")
    other = F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(-1))).otherwise(F.expr("sequence(0, blocks - 1)")))
    placed = spread.withColumn("own", own).withColumn("other", other)
    tiles = placed.select(
        F.when(F.col("blocks").isNull(), F.col("key"))
        .otherwise(F.concat_ws("|", "key", F.least("own", "other"), F.greatest("own", "other")))
        .alias("tile"),
        # the block a word is from, where its tile has two
        F.when(F.col("blocks").isNull() | (F.col("own") == F.col("other")), F.lit(-1)).otherwise(F.col("own")).alias("first"),
        "m", "side", "word", "n",
    )
    dealt = tiles.repartition("tile").sortWithinPartitions("tile")
    return dealt.mapInArrow(_compared, "word string, near string, near_n bigint")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): where forms (word, form) lead. A form's count is a multiple of its word's, so no path is a ring."""
    roots = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if roots.join(further, "root", "left_semi").isEmpty():
            return roots
        next_ = roots.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"))
        before, roots = roots, stored(next_, "roots")
        dropped(before)


def variants(words: DataFrame, times: int = TIMES, tile: int = TILE) -> DataFrame:
    """word, form, root, n, n_near, form_n for every row of ``words`` (``word``, ``n``; words distinct).

    A word's form is its near word of the largest n, of those the first in code
    point order, if that n is at least ``times`` the word's own; else null. The
    root is where forms lead, the word itself if it has none. ``n_near`` counts
    near words. No words give no rows.
    """
    words = stored(words, "words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form")))
    near = near_words(words, tile).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    joined = words.join(near, "word", "left")
    wins = -F.col("best.less") >= F.col("n") * times
    labelled = joined.select(
        "word",
        F.when(wins, F.col("best.form")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(wins, -F.col("best.less")).alias("form_n"),
    )
    labelled = stored(labelled, "word-forms")
    roots = _roots(labelled.where("form IS NOT NULL").select("word", "form"))
    return labelled.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(docs: DataFrame, edit: Callable[[str], Callable[[str], str]] | None = None) -> DataFrame:
    """``variants`` of the words of ``docs`` (``doc_id``, ``text``; other columns are ignored).

    A null text has no words; a null id is the empty text to ``edit``; rows that
    repeat count each time. An empty table gives no rows.
    """
    return variants(word_counts(docs, edit))
