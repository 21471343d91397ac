"""Scalar functions on the cases that their rules are about."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quarry.functions import keys, text
from quarry.operators import facets, guards, search, tagging


def apply(spark, fn, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.x for r in df.select("i", fn(F.col("v")).alias("x")).orderBy("i").collect()]


def test_slugs(spark):
    assert apply(spark, text.slugify, ["Élan Vital", "Straße 1", "a--b", " x ", "A.B_c-9", None]) == ["elan-vital", "stra-e-1", "a--b", "x", "a.b_c-9", None]
    assert apply(spark, lambda c: text.slugify(c, exact=True), ["ﬁne Ⅷ", "ế"]) == ["fine-viii", "e"]


def test_html(spark):
    got = apply(spark, text.strip_html, ["<p>a<br/>b</p>", "<script>x</script>a<STYLE a=1>y</style >b", "1 &lt; 2 &amp;amp; &eacute;&#233; &nbsp;x", None, "&lt;p&gt;"])
    assert got == ["a b", "a b", "1 < 2 &amp; éé x", "", "<p>"]


def test_titles(spark):
    got = apply(spark, text.clean_title, ["<p>Children <18 years</p>", "SpO2 < 90% &amp; more", "Compare <A and B> groups", 'see <a href="x">this</a> &amp; that', "a\x07b\n c", "<script>x</script>T", None])
    assert got == ["Children <18 years", "SpO2 < 90% &amp; more", "Compare <A and B> groups", "see this & that", "ab c", "T", ""]


def test_references_without_semicolon_are_text(spark):
    values = ["<b>a</b> &amp;&amp", "x &eacute;&eacute &#233;&#233 &amp", "&amp;lt; &notit; &amp;eacute;", "&ampx; &copy"]
    want = ["a &&amp", "x é&eacute é&#233 &amp", "&lt; &notit; &eacute;", "&ampx; &copy"]
    assert apply(spark, text.strip_html, values) == want
    assert apply(spark, text.clean_title, [f"<p>{v}</p>" for v in values]) == want


def test_words(spark):
    assert apply(spark, lambda c: text.first_words(c, 2), [" a  b\tc", "", None]) == ["a b", "", ""]
    assert apply(spark, text.word_count, ["", " a b ", None]) == [0, 2, 0]
    assert apply(spark, text.year_of, ["2021-02", "x2021", None]) == [2021, None, None]


def test_urls(spark):
    assert apply(spark, keys.normalize_url, ["HTTPS://WWW.X.org/A/b//?q#f", "x.org", "http://", "//", None, "www.X.org/P?x"]) == ["x.org/A/b", "x.org", None, None, None, "x.org/P"]
    fn = lambda c: keys.url_key(c, ("openneuro.org/datasets", "a.org/b/c"))
    assert apply(spark, fn, ["https://openneuro.org/datasets/", "https://openneuro.org/datasets/ds1", "https://x.org/y", "a.org/b/c"]) == [None, "openneuro.org/datasets/ds1", None, None]


def test_dois(spark):
    assert apply(spark, keys.doi_key, ["https://doi.org/10.18112/OpenNeuro.ds1.v1.0.0", "https://dx.doi.org/10.1000/x", "10.1/x", "doi:10.1234/a.v2b"]) == ["10.18112/openneuro.ds1", None, None, "10.1234/a.v2b"]
    assert apply(spark, keys.extract_dois, ["see 10.1000/AB.c, (10.1000/ab.c) and 10.5555/z."]) == [["10.1000/ab.c", "10.5555/z"]]


def test_fingerprints(spark):
    assert apply(spark, keys.title_fingerprint, ["The MRI of the Brain, brain!", "data of the", None, "Élan"]) == ["brain mri", None, None, "lan"]


def test_sample_sizes(spark):
    got = apply(spark, lambda c: text.sample_size(c), ["18 subjects", "18 subjects, 200 recordings", "1,000 Patients; 1000 participants", "5 images 6 images", None])
    assert [g and tuple(g) for g in got] == [(18, "participants"), None, (1000, "participants"), None, None]


def test_csv_cells(spark):
    assert apply(spark, text.csv_cell, ['a"b', " =1+1", None, "x"]) == ['"a""b"', "\"' =1+1\"", '""', '"x"']


def test_display(spark):
    assert apply(spark, text.safe_href, ["https://x", "javascript:1", None, " http://y "]) == ["https://x", None, None, "http://y"]
    assert apply(spark, lambda c: text.human_bytes(c.cast("long")), ["12", "1536", None, str(3 << 40)]) == ["12 B", "1.5 KB", None, "3.0 TB"]
    assert apply(spark, text.plain, ["a`b|c\nd\x00"]) == ["a'b\\|c d"]
    assert apply(spark, lambda c: text.truncate(c, 4), ["abcd", "abcde"]) == ["abcd", "abc…"]
    assert apply(spark, text.escape_html, ["<a href='x'>&\""]) == ["&lt;a href=&#39;x&#39;&gt;&amp;&quot;"]
    assert apply(spark, lambda c: F.round(text.node_size(c.cast("int")), 3), ["0", "99"]) == [2.0, 6.0]


def test_licenses_and_aliases(spark):
    table = {"CC0": "CC0-1.0", "MIT License": "MIT"}
    assert apply(spark, lambda c: text.license_code(c, table), ["CC0", " mit   license", "other", None]) == ["CC0-1.0", "MIT", None, None]
    assert apply(spark, lambda c: text.alias(c, {"tbi": "injury"}), [" TBI ", " Other "]) == ["injury", "Other"]


def test_terms(spark):
    terms = {"brain": ("meg", "brain scan*"), "heart": ("ecg",)}
    got = apply(spark, lambda c: text.F.array_join(tagging.tagged(c, terms), ","), ["a MEG study", "omega", "Brain   scanning", "émeg", "ecg, meg"])
    assert got == ["brain", "", "brain", "", "brain,heart"]
    assert apply(spark, lambda c: tagging.evidence(c, terms["brain"]), ["Meg meg brain scans"]) == [["Meg", "brain scans"]]
    assert apply(spark, lambda c: tagging.species(c, ("mouse", "mice"), ("patients",)), ["mice", "mice and patients", "x"]) == ["animal", None, None]
    for bad in ({"x": ("abc*",)}, {"x": ("a*b",)}, {"x": (" ",)}):
        with pytest.raises(ValueError):
            tagging.check_terms(bad)
    with pytest.raises(ValueError):
        tagging.check_terms({"x": ("term",)}, ("y",))


def test_guards(spark):
    df = spark.createDataFrame([("short one", "a short one here"), ("oneword12345", "oneword12345"), ("Two  Words here", "has two words\nhere"), (None, "x")], "q string, t string")
    assert [r.x for r in df.select(guards.evidenced(F.col("q"), F.col("t")).alias("x")).collect()] == [False, False, True, False]
    df = spark.createDataFrame([("1,204 cases of 5%", "1204 and 5"), ("12 cases", "112 cases"), ("none", "")], "q string, t string")
    assert [r.x for r in df.select(guards.numbers_grounded(F.col("q"), F.col("t")).alias("x")).collect()] == [True, False, True]
    df = spark.createDataFrame([("alpha beta gamma", "alpha beta"), ("alpha beta", "alpha"), ("a b", "")], "q string, t string")
    assert [r.x for r in df.select(guards.grounded(F.col("q"), F.col("t")).alias("x")).collect()] == [True, False, True]


def test_search_tiers(spark):
    rows = [("1", "Sleep study", "x"), ("2", "Asleep cohort", "x"), ("3", "Other", "about sleep"), ("4", "sleep", ""), ("5", "None", "y"), ("6", "Sleeping very long name indeed", "")]
    df = spark.createDataFrame(rows, "id string, name string, other string")
    assert [r.id for r in search.search(df, " SLEEP ", F.col("other")).collect()] == ["4", "1", "6", "2", "3"]
    assert search.search(df, "  ", F.col("other")).count() == 0
    assert [r.id for r in search.search(df, "stu sle", F.col("other")).collect()] == ["1"]


def test_query_strings():
    q = facets.FacetQuery.parse("?domain=a,b&access=open&years=1990-&q=x+y&sort=years-desc&unknown=1")
    assert (q.chosen, q.years, q.q, q.sort, q.descending) == ({"domain": ("a", "b"), "access": ("open",)}, (1990, None), "x y", "years", True)
    assert facets.FacetQuery.parse(q.format()) == q
    assert q.active() == 4
    assert facets.FacetQuery.parse("years=abc&sort=bad") == facets.FacetQuery()
    assert facets.FacetQuery().format() == ""


def test_missing_values_sort_last_both_ways(spark):
    rows = [("1", "b", None, None, None), ("2", "a", 2000, None, 5), ("3", "c", None, 1999, None), ("4", "a", 2000, 2001, 1)]
    df = spark.createDataFrame(rows, "id string, name string, year_start int, year_end int, sample_size long").withColumns({"access": F.lit("x"), "source": F.lit("s")})
    ids = lambda q: [r.id for r in facets.page(df, q, ()).orderBy("pos").collect()]
    assert ids(facets.FacetQuery(sort="years")) == ["3", "2", "4", "1"]
    assert ids(facets.FacetQuery(sort="years", descending=True)) == ["2", "4", "3", "1"]
    assert ids(facets.FacetQuery(sort="size", descending=True)) == ["2", "4", "1", "3"]
    assert [r.id for r in facets.page(df, facets.FacetQuery(), (), chunk=1, chunks=2, skip=1).orderBy("pos").collect()] == ["4", "1"]


def test_terms_of_any_script_in_either_case(spark):
    terms = {"over": ("über", "élan vi*"), "mid": ("midi",)}
    values = ["Über uns", "ÜBER", "ÉLAN\nVital, über", "x MIDI", "mıdi m\u0130di", "élan\x0bvital", "\u00fcberall"]
    assert apply(spark, lambda c: text.F.array_join(tagging.tagged(c, terms), ","), values) == ["over", "over", "over", "mid", "", "", ""]
    assert apply(spark, lambda c: text.F.array_join(tagging.evidence(c, terms["over"]), "|"), values[:3]) == ["Über", "ÜBER", "über|ÉLAN\nVital"]


def test_newer_letters_are_letters(spark):
    """As RE2 has them, whatever Unicode the JVM has: U+31350 and U+1DF25 are of Unicode 15, U+0345 folds to a letter."""
    values = ["\U00031350lasted", "lasted\U0001df25", "a thing\U00031350\U0001df25 x", "things\u0345.", "thing\u0301"]
    assert apply(spark, lambda c: text.F.array_join(tagging.evidence(c, ("thing*", "lasted")), "|"), values) == ["", "", "thing\U00031350\U0001df25", "things\u0345", "thing"]


def test_html_as_its_sql(spark, tmp_path):
    """Odd pages against the query's SQL: elements within elements, ends of tags, blanks that are none in HTML, references that the SQL leaves."""
    import duckdb

    from quarry.plans import record_queries

    pages = ["<noscript><script>a</noscript>b</script>c", "<style><noscript></style>d</noscript>", "<script/src=x>a</script>b", "<scripts>a</scripts>b", "<ſcript>a</SCRIPT\n>b", "<script>a</script\x0b>b</script>"]
    pages += ["a\x0bb", "a b", " 　a ", "&nbsp;&#39;&eacute;&#233;&AMP;&lt;&amp;lt;&amp", None, ""]
    spark.createDataFrame([(i, h) for i, h in enumerate(pages)], "page_id long, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    got = record_queries.html_text(spark, str(tmp_path)).orderBy("page_id").collect()
    assert [tuple(r) for r in got] == sorted(con.execute(record_queries.HTML_SQL).fetchall())
