"""Benchmark decontamination with a positional inverted index of the training texts.

``build_index`` stores one posting (document, position, term) for every training
token whose term occurs in the test items; each task indexes the documents it
has read, no posting is moved. A search takes, for every window of ten test
words, the lists of its two rarest terms first. Each posting, less the term's
place in the item, gives the place where the item would begin; lists are
intersected on (document, item, beginning). Only documents where two lists agree
are looked up for all other terms of the item, in the same way. DataFrame
operations only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from larder.llm.common import ascii_lower, stored, text_or_empty

WINDOW = 10
# how many of a window's lists are intersected over all documents
RAREST = 2

# ASCII that is no letter or digit parts words; text is in lower case by then
_TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_DOC = ["no_id", "id", "text_hash"]
_PLACE = [*_DOC, "item", "begin"]


@dataclass(frozen=True)
class Items:
    """Test items as tables: ``names`` (item, item_id, n), ``words`` (item, place, term) and ``terms`` (word, term)."""

    names: DataFrame
    words: DataFrame
    terms: DataFrame


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` plus columns that tell its rows apart; equal rows share them."""
    text = text_or_empty()
    return docs.select(
        "*",
        F.col("doc_id").isNull().alias("no_id"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)).alias("id"),
        F.xxhash64(text, F.octet_length(text)).alias("text_hash"),
    )


def _words(text):
    return F.regexp_extract_all(ascii_lower(text), F.lit(_TERM), F.lit(0))


def prepared(benchmark: DataFrame) -> Items:
    """The words of ``benchmark`` (``item_id``, ``text``); items without any are left out."""
    rows = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), _words(text_or_empty()).alias("all")
    )
    names = stored(
        rows.where(F.size("all") > 0).distinct().withColumn("item", F.monotonically_increasing_id()), "test-items"
    )
    placed = names.select("item", F.posexplode("all").alias("place", "word"))
    # the empty term stands for the end of a document
    own = placed.select("word").distinct().where("word <> ''")
    terms = own.withColumn("term", F.monotonically_increasing_id() + 1)
    end = names.sparkSession.range(1).select(F.lit("").alias("word"), F.lit(0).cast("bigint").alias("term"))
    terms = stored(terms.unionByName(end), "test-terms")
    words = stored(placed.join(terms, "word").select("item", "place", "term"), "test-words")
    return Items(names.select("item", "item_id", F.size("all").alias("n")), words, terms)


def build_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Postings (no_id, id, text_hash, at, term) of ``docs`` for the words in ``terms``.

    Each document has a last posting of term 0 behind its last word.
    """
    every = keyed(docs.select("doc_id", "text")).select(
        *_DOC, F.posexplode(F.array_append(_words(text_or_empty()), F.lit(""))).alias("at", "word")
    )
    return stored(every.join(terms, "word").select(*_DOC, "at", "term"), "postings")


def _windows(items: Items) -> DataFrame:
    """(item, start, place, term) of each word of each window; ``start`` is the window's first place."""
    last = F.greatest(F.col("n") - WINDOW, F.lit(0))
    starts = items.names.select("item", "n", F.explode(F.sequence(F.lit(0), last)).alias("start"))
    places = starts.select(
        "item", "start", F.explode(F.sequence("start", F.least(F.col("start") + WINDOW, F.col("n")) - 1)).alias("place")
    )
    return places.join(items.words, ["item", "place"])


def _anchors(index: DataFrame, items: Items) -> DataFrame:
    """(item, start, place, term, rarity): the rarest places of each window, by training count."""
    counts = stored(index.groupBy("term").agg(F.count("*").alias("n")), "term-counts")
    rare = Window.partitionBy("item", "start").orderBy(F.coalesce("n", F.lit(0)), "place")
    return (
        _windows(items)
        .join(counts, "term", "left")
        .withColumn("rarity", F.row_number().over(rare))
        .where(F.col("rarity") <= RAREST)
        .drop("n")
    )


def _looked_up(index: DataFrame, wanted: DataFrame, items: Items) -> DataFrame:
    """All words of the wanted (document, item, begin) that stand in place: plus ``place``."""
    docs = stored(wanted.select(*_DOC).distinct(), "candidate-documents")
    near = index.where("term > 0").join(docs, _DOC, "left_semi")
    probes = wanted.join(items.words, "item").withColumn("at", F.col("begin") + F.col("place"))
    return near.join(probes, [*_DOC, "at", "term"]).select(*_PLACE, "place").distinct()


def phrase_matches(index: DataFrame, items: Items) -> DataFrame:
    """(no_id, id, text_hash, item, at): document words inside an occurrence of a window of the item."""
    anchors = stored(_anchors(index, items).select("item", "place", "term").distinct(), "anchors")
    begins = index.join(anchors, "term").select(*_DOC, "item", (F.col("at") - F.col("place")).alias("begin"), "place")
    agreeing = (
        begins.groupBy(*_PLACE)
        .agg(F.count_distinct("place").alias("agree"))
        .join(items.names.select("item", "n"), "item")
        .where(F.col("agree") >= F.least(F.lit(RAREST), F.col("n")))
        .select(*_PLACE)
    )
    found = _looked_up(index, stored(agreeing, "agreeing"), items)
    # a run of matching places as long as a window is covered by windows, whole
    run = F.col("place") - F.row_number().over(Window.partitionBy(*_PLACE).orderBy("place"))
    runs = found.withColumn("run", run)
    long = F.count("*").over(Window.partitionBy(*_PLACE, "run"))
    return (
        runs.withColumn("length", long)
        .join(items.names.select("item", "n"), "item")
        .where(F.col("length") >= F.least(F.lit(WINDOW), F.col("n")))
        .select(*_DOC, "item", (F.col("begin") + F.col("place")).alias("at"))
    )


def proximity_matches(index: DataFrame, items: Items, slop: int) -> DataFrame:
    """(no_id, id, text_hash, item, start, begin): windows all of whose words stand near their place.

    A word is near if it is at most ``slop`` positions from where it would be if
    the item began at ``begin``, which the window's rarest word decides; order is
    free. The second list must agree within twice the slop before others are read.
    """
    anchors = stored(_anchors(index, items), "window-anchors")
    step = 2 * slop + 1
    begins = index.join(anchors, "term").select(
        *_DOC, "item", "start", "rarity", (F.col("at") - F.col("place")).alias("begin")
    )
    first = begins.where("rarity = 1").withColumn(
        "band", F.explode(F.array(*[F.floor(F.col("begin") / step) + d for d in (-1, 0, 1)]))
    )
    second = begins.where("rarity = 2").select(
        *_DOC, "item", "start", F.floor(F.col("begin") / step).alias("band"), F.col("begin").alias("other")
    )
    window = [*_DOC, "item", "start"]
    near_pairs = (
        first.join(second, [*window, "band"])
        .where(F.abs(F.col("begin") - F.col("other")) <= 2 * slop)
        .select(*window, "begin")
    )
    # a one-word item has no second list
    single = begins.join(items.names.where("n = 1").select("item"), "item").select(*window, "begin")
    wanted = stored(near_pairs.unionByName(single).distinct(), "near-windows")
    docs = stored(wanted.select(*_DOC).distinct(), "near-documents")
    probes = wanted.join(_windows(items), ["item", "start"])
    met = (
        index.where("term > 0")
        .join(docs, _DOC, "left_semi")
        .join(probes, [*_DOC, "term"])
        .where(F.abs(F.col("at") - F.col("begin") - F.col("place")) <= slop)
    )
    whole = met.groupBy(*window, "begin").agg(F.count_distinct("place").alias("met"))
    sized = whole.join(items.names.select("item", "n"), "item")
    return sized.where(F.col("met") == F.least(F.lit(WINDOW), F.col("n"))).select(*window, "begin")


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per row of ``docs``: key columns, doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A window is ten consecutive words of an item, or the whole of a shorter one;
    a document word inside an occurrence of any window is hit. Null and wordless
    texts have no words and are never contaminated, wordless items match nothing.
    Rows that share an item id are one item with several texts; a null item id is
    the empty string. Rows that repeat a document get the same result each.
    Without items no document is contaminated; an empty table gives no rows.
    """
    items = prepared(benchmark)
    index = build_index(docs, items.terms)
    hits = stored(phrase_matches(index, items), "hits")
    words = hits.select(*_DOC, "at").distinct().groupBy(*_DOC).agg(F.count("*").alias("n_hit"))
    named = hits.select(*_DOC, "item").distinct().join(items.names.select("item", "item_id"), "item")
    listed = named.groupBy(*_DOC).agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    ends = index.where("term = 0").select(*_DOC, F.col("at").cast("bigint").alias("n_words"))
    n_hit = F.coalesce("n_hit", F.lit(0))
    return ends.join(words.join(listed, _DOC), _DOC, "left").select(
        *_DOC,
        F.expr("if(no_id, null, id)").alias("doc_id"),
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")).cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no window of an item occurs, all columns kept."""
    bad = stored(contamination(docs, benchmark).where("contaminated").select(*_DOC).distinct(), "contaminated")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", "text")
    return keyed(whole).join(bad, _DOC, "left_anti").select("row.*")
