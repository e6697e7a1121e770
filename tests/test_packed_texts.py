"""Text columns shuffled as one: their order, their values, the survivors of a key."""

from itertools import product

from pyspark.sql import functions as F

from larder.operators.clean import keep_one, pack_texts, unpack_texts


def test_packed_texts_give_back_and_sort_as_their_columns(spark):
    """Also where texts hold the characters that packing uses, are empty or NULL."""
    some = [None, "", " ", "a", "a\u0000", "a\u0000b", "a\u0001", "\u0000", "\u0000\u0001", "\u0001\u0000", "\u0001\u0001", "\u0001\u0002", "\u0002", "\u0003", "ab", "é", "￿", "😀"]
    rows = spark.createDataFrame([(x, y, x) for x in some for y in some], "a string, b string, c string")
    packed = rows.withColumn("p", pack_texts(["a", "b", "c"])).withColumn("s", F.split("p", "\u0000", -1))
    back = unpack_texts("s", ["a", "b", "c"])
    assert packed.select("a", "b", "c").collect() == packed.select(*back).collect()
    by_columns = rows.coalesce(1).sort(*[F.col(n).asc_nulls_last() for n in "abc"]).collect()
    assert by_columns == packed.coalesce(1).sort("p").select("a", "b", "c").collect()


def test_survivor_of_a_key_by_columns_between_and_within_packed_texts(spark):
    some = [None, "", "a", "a\u0000", "b"]
    rows = [(k % 3 if k % 7 else None, x, y, n, z, x) for k, (x, y, n, z) in enumerate(product(some, some, [None, 1, 2], some))]
    df = spark.createDataFrame(rows, "k int, a string, b string, n int, c string, d string").repartition(5)
    last = lambda v: (v is None, v or (0 if isinstance(v, int) else "")) if v is not None else (True, 0)
    expected = {k: min((r for r in rows if r[0] == k), key=lambda r: [last(v) for v in r[1:]]) for k in {r[0] for r in rows}}
    kept = keep_one(df, ("k",))
    assert kept.columns == df.columns and {r.k: tuple(r) for r in kept.collect()} == expected
