"""Mixing of sources on hard cases; the whole table is checked against SQL."""

from collections import defaultdict

from larder.llm import mixing

SCHEMA = "doc_id long, text string, source string, mix_rank string, mix_class string, mix_copy int"


def rows_of(spark, rows):
    """Columns that clash with the operator's own."""
    return spark.createDataFrame([(*r, "r", "c", 7) for r in rows], SCHEMA)


def plain(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def mix(df):
    return [(r.doc_id, r.mix_size, r.mix_source_size, r.mix_target, r.mix_copies) for r in mixing.mixed(mixing.measured(df)).collect()]


def test_nulls_empties_and_repeated_rows(spark):
    rows = [(k, "one two three four", "a") for k in range(50)]
    rows += [(100 + k, "word " * (k % 9), None) for k in range(40)]
    rows += [(200, None, "b"), (201, "", "b"), (202, " \t\n", "b")]
    rows += [(None, "no id at all", "c")] * 3 + [(300, "same row twice", "c")] * 2 + [(301, "x" * 100_000 + " y" * 50_000, "c")]
    got = mix(plain(spark, rows))
    assert len(got) == len(rows)
    sizes = {"a": 200, None: sum(k % 9 for k in range(40)), "b": 0, "c": 12 + 6 + 50_001}
    assert {r[2] for r in got} == set(sizes.values())
    by_size = defaultdict(list)
    for r in got:
        by_size[r[2]].append(r)
        assert 0 <= r[4] <= 3
    # sources of nothing take nothing; a target is at most three times the source's size
    assert all(r[3] == 0 and r[4] == 0 for r in by_size[0])
    total = sum(sizes.values())
    assert abs(sum(by_size[s][0][3] for s in by_size) - min(total, 3 * total)) < 1e-6 * total
    for size, some in by_size.items():
        assert some[0][3] <= 3 * size
        # hit floor or ceil of the expected number of documents
        rate = some[0][3] / size if size else 0
        assert abs(sum(r[4] for r in some) - rate * len(some)) < 1
    assert sorted(map(str, got)) == sorted(map(str, mix(plain(spark, rows[::-1]).repartition(7))))


def test_one_source_and_ties(spark):
    rows = [(k, "a b c", "only") for k in range(30)]
    assert {(r[3], r[4]) for r in mix(plain(spark, rows))} == {(90.0, 1)}


def test_one_source_holds_nearly_all(spark):
    rows = [(k, "w " * 10, "big") for k in range(3000)] + [(5000 + k, "w " * 10, s) for k, s in enumerate("xyz")]
    got = mix(plain(spark, rows))
    small = [r for r in got if r[2] == 10]
    assert len(small) == 3 and all(r[3] == 30 and r[4] == 3 for r in small)
    assert abs(sum(r[1] * r[4] for r in got) - 30_030) <= 10


def test_drawn_keeps_columns_and_rows(spark):
    rows = [(k, "a b", "s") for k in range(20)] + [(None, None, None)]
    df = plain(spark, rows).withColumn("n_chars", mixing.F.lit(3))
    got = mixing.drawn(df)
    assert got.columns == df.columns and 19 <= got.count() <= 21
    assert mixing.drawn(df.limit(0)).collect() == [] and mix(df.limit(0)) == []


def test_other_columns_of_any_name(spark):
    rows = [(k, "a b", "s") for k in range(10)]
    df = rows_of(spark, rows).drop("mix_rank", "mix_class", "mix_copy").withColumn("text_hash", mixing.F.lit("x"))
    assert {r.text_hash for r in mixing.drawn(df).collect()} == {"x"}
    clashing = rows_of(spark, rows)
    got = mixing.drawn(clashing)
    assert got.columns == clashing.columns
    assert {(r.mix_rank, r.mix_class, r.mix_copy) for r in got.collect()} == {("r", "c", 7)} and got.count() == 10
