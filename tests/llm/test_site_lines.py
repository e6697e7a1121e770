"""Site-relative line dedup on hard cases; the whole table is checked against SQL."""

from larder.llm.site_lines import html_lines, without_boilerplate

SCHEMA = "page_id long, url string, html string, host string, lines string"


def test_hard_cases(spark):
    rows = [(k, f"https://U@Site.example:80/{k}", f"<p>Own {k}<p>menu</p><p> menu </p><script>x<p>y</script>a<b>b</b>c") for k in range(10)]
    rows += [(20, "https://small.example/", "<p>menu"), (21, None, None), (22, "no host", ""), (23, "http://site.example", "<!-- c\n -->"), (0, rows[0][1], rows[0][2])]
    df = spark.createDataFrame([(*r, "clash", None) for r in rows], SCHEMA)
    got = sorted(map(tuple, without_boilerplate(df, 0.3, 5).collect()))
    want = [(k, "site.example", 4, 3, f"Own {k}") for k in range(10)] + [(0, "site.example", 4, 3, "Own 0")]
    want += [(20, "small.example", 1, 0, "menu"), (21, "", 0, 0, ""), (22, "", 0, 0, ""), (23, "site.example", 0, 0, "")]
    assert got == sorted(want)
    assert without_boilerplate(df.limit(0)).collect() == []


def test_long_page(spark):
    df = spark.createDataFrame([("<p>" + "x " * 200_000 + "<br>\n" * 1000 + "<unclosed " * 1000,)], "html string")
    assert df.select(html_lines(df.html).alias("l")).selectExpr("size(l)").first()[0] >= 1


def test_small_hosts(spark):
    """The ratio decides on hosts of every size, once two pages hold the line."""
    rows, want = [], []
    for n in range(1, 10):
        for k in range(n):
            own = f"<p>own {n} {k}<p>footer"
            rows.append((len(rows), f"https://host{n}.example/{k}", own + ("<p>twice" if k < 2 else ""), "", ""))
            common = ["footer", "twice"][: 1 + (k < 2)]
            want.append((f"host{n}.example", len(common) if n > 1 else 0, f"own {n} {k}" if n > 1 else f"own {n} {k}\nfooter\ntwice"))
    got = without_boilerplate(spark.createDataFrame(rows, SCHEMA))
    assert sorted((r.host, r.n_dropped, r.kept_text) for r in got.collect()) == sorted(want)


def test_repeated_pages_without_scheme(spark):
    rows = [(1, "plain.example/a", "<p>one<p>two", "", "")] * 3 + [(2, "other.example", "<p>three", "", "")]
    got = without_boilerplate(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.host for r in got} == {""} and sorted(r.kept_text for r in got) == ["", "", "", "three"]
