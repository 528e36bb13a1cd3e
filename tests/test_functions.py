"""Values worked out by hand for the column functions and small operators."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from webloom.functions import html, text, url
from webloom.operators import ai, classify, fetchlog, frontier, graph, index, neardup, render, state, validate


def one(spark, col, **values):
    return spark.createDataFrame([tuple(values.values())], list(values)).select(col.alias("x")).first()[0]


@pytest.mark.parametrize(("word", "value"), [("a", -5808556873153909620), ("foo", -2543842089295555209), ("foobar", 9625390261332436968 - 2**64), ("", text.FNV_START)])
def test_fnv(spark, word, value):
    assert one(spark, text.fnv1a(F.col("w")), w=word) == value
    assert (text.fnv1a_bytes(word.encode()) - value) % 2**64 == 0


def test_fnv_of_wide_characters(spark):
    for w in ("é", "中文", "\U0001f600x"):
        assert (one(spark, text.fnv1a(F.col("w")), w=w) - text.fnv1a_bytes(w.encode())) % 2**64 == 0


def test_simhash(spark):
    rows = [(1, " \n"), (2, "foo"), (3, "a b"), (4, None), (5, "x y")]
    docs = spark.createDataFrame(rows, "k long, t string")
    fast = dict(neardup.fingerprints(docs, "k", F.col("t")).collect())
    plain = dict(neardup.fingerprints_sql(docs, "k", F.col("t")).collect())
    assert fast == plain
    a, b = text.fnv1a_bytes(b"a"), text.fnv1a_bytes(b"b")
    assert fast[1] == 0 and fast[4] == 0 and fast[2] == -2543842089295555209 and fast[3] % 2**64 == a & b
    assert fast[5] % 2**64 == text.fnv1a_bytes("x y".encode())


def test_near_pairs_equal_brute_force(spark):
    import random

    random.seed(3)
    base = [random.getrandbits(64) - 2**63 for _ in range(20)]
    fps = base + [f ^ sum(1 << i for i in random.sample(range(63), random.randint(0, 5))) for f in base for _ in range(3)]
    df = spark.createDataFrame(list(enumerate(fps)), "k long, fp long")
    want = {(i, j, d) for i in range(len(fps)) for j in range(i + 1, len(fps)) if (d := ((fps[i] ^ fps[j]) % 2**64).bit_count()) <= 3}
    assert {tuple(r) for r in neardup.near_pairs(df, "k").collect()} == want

def test_simhash_equals_a_loop_over_words(spark):
    import random

    random.seed(5)
    rows = ["", " \n", None, "é 中文 x", "b" * 70000 + " " + "c" * 66000, " ".join(["w"] * 700), " ".join(random.choice(["foo", "bar", "x" * 300]) for _ in range(900))]
    rows += ["".join(random.choice("ab \n\té中") for _ in range(random.randint(0, 60))) for _ in range(60)]

    def plain(t):
        words = [w for w in (t or "").replace("\n", " ").replace("\t", " ").split(" ") if w]
        h = [text.fnv1a_bytes(w.encode()) for w in words]
        f = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
        return f - (f >> 63 << 64)

    docs = spark.createDataFrame(list(enumerate(rows)), "k long, t string").coalesce(1)
    assert dict(neardup.fingerprints(docs, "k", F.col("t")).collect()) == {i: plain(t) for i, t in enumerate(rows)}


def _times_read(spark, build):
    """The pairs or classes of twenty rows, and how often their rows were computed meanwhile."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(x):
        seen.add(1)
        return x

    df = spark.range(20).select(F.col("id").alias("k"), counted(F.col("id") % 5).alias("fp"))
    rows = build(df).collect()
    return rows, seen.value


def test_fingerprints_are_computed_once_for_pairs(spark):
    rows, n = _times_read(spark, lambda df: neardup.near_pairs(df, "k"))
    assert n == 20 and len(rows) == 20 * 19 // 2


def test_fingerprints_are_computed_once_for_classes(spark):
    rows, n = _times_read(spark, lambda df: neardup.near_classes(df, "k"))
    assert n == 20 and {tuple(r) for r in rows} == {(k, k % 5, k % 5, 4) for k in range(20)}


def test_simhash_keeps_no_words_between_batches():
    import tracemalloc

    import pyarrow as pa

    def batches():
        for i in range(40):
            yield pa.array([" ".join(f"w{i}x{j}" for j in range(k, k + 500)) for k in range(0, 5000, 500)])

    tracemalloc.start()
    try:
        for _ in text.simhash.func(batches()):
            pass
        now, peak = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert peak < 8e6


def test_near_pairs_expand_no_whole_class_in_a_task(spark, monkeypatch):
    import random

    random.seed(4)
    monkeypatch.setattr(neardup, "LOT_KEYS", 4)
    base = [random.getrandbits(64) - 2**63 for _ in range(3)]
    fps = [base[0]] * 60 + [base[0] ^ 7] * 30 + [base[1]] * 2 + [base[1] ^ 1, base[2], base[2] ^ 15]
    df = spark.createDataFrame(list(enumerate(fps)), "k long, fp long")
    got = neardup.near_pairs(df, "k")
    want = {(i, j, d) for i in range(len(fps)) for j in range(i + 1, len(fps)) if (d := ((fps[i] ^ fps[j]) % 2**64).bit_count()) <= 3}
    rows = [tuple(r) for r in got.collect()]
    assert set(rows) == want and len(rows) == len(want)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else tables as small as this make one task
    try:
        largest = max(r["n"] for r in got.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert largest < 2 * len(want) // 3


def test_text_functions(spark):
    assert one(spark, text.count_of(F.col("t"), "aa"), t="aaaa") == 2
    assert one(spark, text.safe_filename(F.col("u")), u="https://a.b/c?x=1") == "https___a_b_c?x=1.md"
    assert one(spark, text.legacy_filename(F.col("u")), u="https://a.b/") == "a_b_index"
    assert one(spark, text.clean_word(F.col("w")), w="Fóo-Bar_9!") == "fobar9"
    assert one(spark, text.escaped_content(F.col("l")), l='{"content": "a\\nb\\"c"}') == 'a\\nb\\"c'
    assert one(spark, render.unescaped(F.col("l")), l='a\\nb\\"c') == 'a\nb"c'


def test_index_keeps_words_of_four_letters(spark):
    docs = spark.createDataFrame([(1, "abc abcd ABCD! x"), (2, "abcd"), (3, None)], "k long, t string")
    assert [tuple(r) for r in index.inverted_index(docs, "k", F.col("t")).collect()] == [("abcd", [1, 2])]


def test_urls(spark):
    cases = [("http://a.org/x/y", "../z#f", "http://a.org/z"), ("http://a.org/x", "//b.org/q", "http://b.org/q"), ("http://a.org/x", "http://[bad", None), ("http://a.org/x", None, None)]
    df = spark.createDataFrame(cases, "b string, r string, w string")
    assert all(r.got == r.w for r in df.select("w", url.resolve("b", "r").alias("got")).collect())
    assert one(spark, url.ignored_host(F.col("h")), h="latest.example.com")
    assert one(spark, url.in_crawl_scope(F.col("u"), "example.com"), u="https://badexample.com/x")
    assert not one(spark, url.in_crawl_scope(F.col("u"), "example.com", strict=True), u="https://badexample.com/x")
    assert one(spark, url.host_of(F.col("u")), u="::not a url") is None
    assert one(spark, url.is_asset(F.col("u")), u="http://a/b.pdf") and not one(spark, url.is_asset(F.col("u")), u="http://a/b.PDF")


def _category(spark, u, t, **k):
    df = spark.createDataFrame([(u, t)], "u string, t string")
    return tuple(classify.classify(df, F.col("u"), F.col("t"), **k).select("category", "score").first())


def test_classification_thresholds(spark):
    assert _category(spark, "", "syllabus syllabus") == ("uncategorized", 2)
    assert _category(spark, "", "syllabus syllabus syllabus") == ("academics", 3)
    assert _category(spark, "", "bursar bursar bursar housing housing housing")[0] == "housing"  # the earlier of equals
    assert _category(spark, "http://gym/gym", None) == ("athletics", 5)
    assert _category(spark, None, None) == ("uncategorized", 0)
    df = spark.createDataFrame([("", "lease " * 25)], "u string, t string")
    assert classify.classify_capped(df, F.col("u"), F.col("t")).first()["score"] == 10
    assert sum(map(len, classify.CATEGORIES.values())) == 242 and len(classify.CATEGORIES) == 24


def test_pagerank_small(spark):
    def ranks(edges, **k):
        e = spark.createDataFrame(edges, "src string, dst string")
        n = e.select(F.col("src").alias("id")).union(e.select("dst")).distinct()
        return dict(graph.pagerank(n, e, **k).collect())

    assert ranks([("A", "B"), ("B", "A")]) == pytest.approx({"A": 1, "B": 1})
    assert ranks([("A", "B")], most=1) == pytest.approx({"A": 0.575, "B": 1.425})
    r = ranks([("A", "B"), ("A", "B"), ("A", "C"), ("C", "A")])
    assert sum(r.values()) == pytest.approx(3) and r["B"] > r["C"]


def test_rank_and_priority(spark):
    pages = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "url string")
    ranks = spark.createDataFrame([("a", 5.0), ("b", 5.0000004), ("c", 5.000001)], "id string, rank double")
    got = {r.url: (r.pagerank, r.priority) for r in render.with_rank(pages, ranks).collect()}
    assert got == {"a": (5.0, "normal"), "b": (5.0, "normal"), "c": (5.000001, "high"), "d": (1.0, "normal")}


def test_state(spark):
    now = dt.datetime(2024, 1, 8)
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 1),), (dt.datetime(2024, 1, 1),), (None,)], "t timestamp")
    assert [r[0] for r in df.select(state.is_fresh(F.col("t"), F.lit(now))).collect()] == [True, False, False]
    times = spark.createDataFrame([("2024-01-02T03:04:05.6",), ("junk",), (None,)], "t string").select(state.parsed_time(F.col("t")).cast("long")).collect()
    assert [r[0] for r in times] == [1704164645, 0, 946684800]
    old = spark.createDataFrame([("a", 1), ("b", 1)], "url string, v int")
    new = spark.createDataFrame([("b", 2), ("b", 3), ("c", 1)], "url string, v int")
    once = state.upsert(old, new, "url", "v")
    assert sorted(map(tuple, once.collect())) == [("a", 1), ("b", 3), ("c", 1)]
    assert sorted(map(tuple, state.upsert(once, new, "url", "v").collect())) == sorted(map(tuple, once.collect()))
    a, b = spark.createDataFrame([(0, "a"), (1, "b")], "pos int, url string"), spark.createDataFrame([(0, "b"), (1, "c")], "pos int, url string")
    assert [r.url for r in state.merged_in_order(a, b).orderBy("src", "pos").collect()] == ["a", "b", "c"]
    marks = state.checkpoint_marks(spark.range(25), "id")
    assert [r.id for r in marks.collect()] == [9, 19]


def test_validation(spark):
    lines = [("",), ("{bad",), ('{"url":null,"title":"a","content":"c"}',), ('{"url":"u","title":"t"}',), ("[1]",), ("  \t",), (None,)]
    got = [r.skip_reason for r in validate.validated(spark.createDataFrame(lines, "value string")).collect()]
    assert got == ["blank", "invalid_json", None, "missing_keys", "invalid_json", "blank", "blank"]
    with pytest.raises(ValueError):
        validate.valid_pages(spark.createDataFrame([("",)], "value string"), need_one=True)


def test_fetch_log(spark):
    df = spark.createDataFrame([(i, "h", a) for i, a in enumerate([0.0, 0.5, 5.0, 5.1, 5.2])], "i int, h string, a double")
    assert [r.slot for r in fetchlog.schedule(df, "h", "a", 2.0, "i").orderBy("i").collect()] == pytest.approx([0, 2, 5, 7, 9])
    assert [one(spark, fetchlog.backoff(F.col("k")), k=k) for k in (1, 2, 3, 9)] == [30, 60, 120, 120]
    assert one(spark, fetchlog.fetch_action(F.lit(None).cast("int"), F.col("k")), k=4) == "blacklist"


def test_model_routing(spark):
    label = F.col("l")
    cases = [("404 page not found", 0.1, 500, "delete"), ("public event, workshop or seminar", 0.4, 500, "keep"), ("public event, workshop or seminar", 0.41, 150, "move"), ("404 page not found", 0.9, 149, "delete_short")]
    df = spark.createDataFrame(cases, "l string, s double, n int, w string")
    assert all(r.got == r.w for r in df.select("w", ai.route(label, F.col("s"), F.col("n")).alias("got")).collect())
    assert len(ai.DIRECTORY_OF) == 32


def test_html():
    page = '<html><head><title>T &amp; x</title><meta property="og:title" content="O"></head><body><nav><a href="/n#f">N</a>menu</nav>tail<p>One<p>Two<script>var a="</p>"</script><table><tr><td>cell</td></tr></table><a href="http://[x">b</a>'
    got = html.read_page(page, "http://a.org/d")
    assert got["title"] == "T & x" and got["og_title"] == "O" and got["links"] == ["http://a.org/n"]
    assert got["content"].split("\n") == ["tail", "One", "Two", "cell", "b"]
    assert html.read_page(page, "http://a.org/d", links_from="clean")["links"] == []
    assert html.read_page(None, None)["content"] == ""


def test_crawl_waves_stop(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a")], "src string, dst string")
    assert sorted(map(tuple, frontier.crawl_waves(spark.createDataFrame([("a",)], "url string"), edges).collect())) == [("a", 0), ("b", 1), ("c", 2)]


def test_seeds(spark):
    none = spark.createDataFrame([], "host string")
    assert frontier.seed_urls(spark, none, "x.org").count() == 4
    assert frontier.brute_force_hosts(spark, "x.org", none).count() == 35
    many = spark.createDataFrame([(f"h{i}.x.org",) for i in range(12)], "host string")
    assert frontier.brute_force_hosts(spark, "x.org", many).count() == 12 and frontier.seed_urls(spark, many, "x.org").count() == 12


def test_report_of_empty_pages(spark):
    pages = spark.createDataFrame([("u", ""), ("v", None), ("w", "<p>text</p>")], "url string, html string")
    got = {r.url: r for r in html.extraction_report(pages).collect()}
    assert len(got) == 3 and got["u"].noise_reduction is None and got["w"].noise_reduction is not None


def test_lookups_read_postings_and_indexes_alike(spark):
    docs = spark.createDataFrame([(1, "Alpha beta"), (2, "alpha gamma"), (3, "beta alpha alpha")], "k int, t string")
    post, whole = index.postings(docs, "k", F.col("t")), index.inverted_index(docs, "k", F.col("t"))
    for words in (["alpha", "BETA"], ["gamma", "beta"], ["none", "alpha"], ["alpha", "alpha"]):
        for how in ("and", "or"):
            assert sorted(r.key for r in index.lookup_all(post, words, how).collect()) == sorted(r.key for r in index.lookup_all(whole, words, how).collect())


def test_schedule_of_a_busy_host_in_blocks(spark):
    times = [("h", float(t % 97 * 11), t) for t in range(300)] + [("g", 5.0, 1000), (None, 1.0, 1001)]
    df = spark.createDataFrame(times, "h string, a double, i int")
    got = {r.i: r.slot for r in fetchlog.schedule(df, "h", "a", 2.5, "i", block=50.0).collect()}
    free = {}
    for h, a, i in sorted(times, key=lambda x: (x[1], x[2])):
        slot = max(a, free.get(h, a))
        free[h] = slot + 2.5
        assert got[i] == pytest.approx(slot)


def test_near_links_and_classes_say_what_pairs_do(spark):
    df = spark.createDataFrame([(1, 5), (2, 5), (3, 7), (4, 1 << 60), (5, 5)], "k int, fp long")
    who = {}
    for r in neardup.near_classes(df, "k").collect():
        who.setdefault(r.fp, set()).add(r.k)
        assert (r.first_key, r.n) == ((1, 3) if r.fp == 5 else (r.k, 1))
    pairs = {(a, b, 0) for ks in who.values() for a in ks for b in ks if a < b}
    pairs |= {(min(a, b), max(a, b), r.dist) for r in neardup.near_links(df).collect() for a in who[r.fp] for b in who[r.fp2]}
    assert pairs == {tuple(r) for r in neardup.near_pairs(df, "k").collect()}


def test_parse_pages_reads_each_page_once(spark):
    pages = spark.createDataFrame([("http://e.org/", "<p>" + "word " * 30)], "url string, html string")
    parsed = html.parse_pages(pages)
    assert parsed.count() == 1
    plan = parsed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [read") == 1


def test_pages_of_a_batch_are_read_in_slices(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(html, "_SLICE_ROWS", 3)
    monkeypatch.setattr(html, "_SLICE_BYTES", 100)
    pages = ["<p>a"] * 7 + ["<p>" + "b" * 500, None, "", "<p>" + "c" * 60, "<p>" + "d" * 60, "<title>t</title><p>é 中<a href='x'>"]
    urls = [f"http://e.org/{i}" for i in range(len(pages) - 1)] + [None]
    parts = list(html.page_udf().func(iter([(pa.array(pages), pa.array(urls)), (pa.array(pages).slice(5, 4), pa.array(urls).slice(5, 4)), (pa.array([], "string"), pa.array([], "string"))])))
    want = [html.read_page(h, u) for h, u in zip(pages, urls, strict=True)]
    assert [r for p in parts for r in p.to_pylist()] == want + want[5:9]
    assert max(map(len, parts)) == 3 and [h for h in map(len, parts)][:4] == [3, 3, 1, 1]


def test_metadata_comes_in_slices_of_a_batch(spark):
    pages = [(f"http://e.org/{i}", f"<title>t{i}</title><meta name='description' content='d{i}'><p>{'x' * 3000}") for i in range(700)] + [("u", None)]
    got = html.page_metadata(spark.createDataFrame(pages, "url string, html string").coalesce(1))
    assert {tuple(r) for r in got.collect()} == {(f"http://e.org/{i}", f"t{i}", "Unknown", f"d{i}") for i in range(700)} | {("u", "No Title", "Unknown", "")}
    parts = [len(p) for p in html.page_udf(html.SIDEBAR_NOISE).func(iter([_arrow_pair(pages)]))]
    assert sum(parts) == 701 and max(parts) <= 256


def _arrow_pair(pages):
    import pyarrow as pa

    return pa.array([h for _, h in pages]), pa.array([u for u, _ in pages])


def test_builtin_simhash_sends_no_words_by_document(spark, monkeypatch):
    import random
    import re

    random.seed(6)
    monkeypatch.setattr(neardup, "COMMON_WORDS", 3)
    monkeypatch.setattr(neardup, "COMMON_BYTES", 4)
    vocabulary = ["the", "of", "a", "é", "中文", "zebra", "x" * 90] + [f"w{i}" for i in range(50)]
    rows = [(i, " ".join(random.choices(vocabulary, k=random.randint(0, 70)))) for i in range(150)] + [(150, None), (151, "the " * 70000)]
    docs = spark.createDataFrame(rows, "k long, t string")
    got = neardup.fingerprints_sql(docs, "k", F.col("t"))
    assert sorted(got.collect()) == sorted(neardup.fingerprints(docs, "k", F.col("t")).collect())
    plan = got._jdf.queryExecution().executedPlan().toString()
    keys = re.findall(r"hashpartitioning\(([^)]*?), \d+\)", plan)
    assert keys and not any("k#" in k and "w#" in k for k in keys)
    assert "SortMergeJoin [w#" not in plan
