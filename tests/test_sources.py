"""Readers, writers, the stream and the whole way from HTML to files."""

import datetime as dt
import json

import pytest

from webloom.operators.ai import keyword_scorer
from webloom.plans import pipeline
from webloom.schemas import PAGE, STATE, Config
from webloom.sources import readers, sinks
from webloom.streaming import incremental


def _line(url, content="c", **more):
    return json.dumps({"url": url, "title": "t", "content": content, "category": "", "links": [], "timestamp": "2024-01-01T00:00:00"} | more)


def test_readers(spark, tmp_path):
    (tmp_path / "p.jsonl").write_text("\n".join([_line("http://a"), "{bad", "", _line("http://a", "d"), _line("http://é")]))
    assert readers.read_pages(spark, str(tmp_path / "p.jsonl")).count() == 3
    assert {r.url for r in readers.known_urls(spark, str(tmp_path / "p.jsonl")).collect()} == {"http://a", "http://é"}
    (tmp_path / "state.json").write_text(json.dumps({"u": {"hash": "h", "category": "c", "last_crawled": "2024-01-01T00:00:00"}}))
    assert readers.read_state(spark, str(tmp_path / "state.json")).first().hash == "h"
    assert readers.read_state(spark, str(tmp_path / "none.json")).count() == 0
    (tmp_path / "bad.json").write_text("{nope")
    assert readers.read_state(spark, str(tmp_path / "bad.json")).count() == 0
    (tmp_path / "queue.json").write_text('["a", "b", "a"]')
    assert readers.read_pending(spark, str(tmp_path / "queue.json")).count() == 3
    readers.consume(spark, str(tmp_path / "queue.json"))
    assert not (tmp_path / "queue.json").exists()
    (tmp_path / "black.txt").write_text(" a \n\nb\na\n")
    assert sorted(r.url for r in readers.read_blacklist(spark, str(tmp_path / "black.txt")).collect()) == ["a", "b"]
    (tmp_path / "ranks.txt").write_text("2.500000\tu\nx\tv\n")
    assert [tuple(r) for r in readers.read_ranks(spark, str(tmp_path / "ranks.txt")).collect()] == [("u", 2.5)]


def test_seed_sources(spark):
    def lines(*x):
        return spark.createDataFrame([(v,) for v in x], "value string")

    def hosts(df):
        return sorted(r.host for r in df.collect())

    log = lines(json.dumps([{"name_value": "*.a.x.org\nb.x.org"}, {"name_value": "other.net"}]))
    assert hosts(readers.certificate_hosts(log, "x.org")) == ["a.x.org"]
    assert hosts(readers.certificate_hosts(log, "x.org", all_names=True)) == ["a.x.org", "b.x.org"]
    assert hosts(readers.archive_hosts(lines(json.dumps([["original"], ["http://a.x.org/p"], ["::"]])))) == ["a.x.org"]
    assert hosts(readers.search_hosts(lines("A.x.org,1.2.3.4", "b.net,1"), "x.org")) == ["a.x.org"]
    assert hosts(readers.search_hosts(lines("a.x.org,1", "error: limit"), "x.org")) == []
    assert hosts(readers.history_hosts(lines('{"subdomains": ["a", "b"]}'), "x.org")) == ["a.x.org", "b.x.org"]


def test_snapshots_and_files(spark, tmp_path):
    base = f"file://{tmp_path}/t"
    for v in (1, 2):
        sinks.write_snapshot(spark.createDataFrame([(v,)], "v int"), base)
        assert [r.v for r in sinks.read_snapshot(spark, base).collect()] == [v]
    sinks.drop_snapshots(spark, base)
    assert not (tmp_path / "t").exists()
    md = spark.createDataFrame([("news", "a.md", "x"), ("events", "b.md", "é")], "category string, filename string, md string")
    sinks.write_markdown_files(md, f"file://{tmp_path}/kb")
    assert (tmp_path / "kb/events/b.md").read_text() == "é"
    assert sorted(r.md for r in readers.read_markdown(spark, f"{tmp_path}/kb/*").collect()) == ["x", "é"]
    sinks.write_markdown(md, f"file://{tmp_path}/parts")
    assert spark.read.parquet(f"{tmp_path}/parts").count() == 2
    pages = spark.createDataFrame([("u", "t", "c\n", None, ["l"], None)], PAGE)
    sinks.write_pages(pages, f"{tmp_path}/out")
    assert readers.read_pages(spark, f"{tmp_path}/out").collect() == pages.collect()


def test_stream_takes_each_file_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    base = f"file://{tmp_path}/kb"
    (tmp_path / "in/1.jsonl").write_text("\n".join([_line("http://a", "housing lease dorm"), _line("http://b", "x")]))
    incremental.run_stream(spark, str(tmp_path / "in"), base, dt.datetime(2024, 1, 1))
    (tmp_path / "in/2.jsonl").write_text("\n".join([_line("http://a", "housing lease dorm"), _line("http://b", "y"), _line("http://c", "z")]))
    incremental.run_stream(spark, str(tmp_path / "in"), base, dt.datetime(2024, 1, 2))
    state = {r.url: (r.category, r.last_crawled.day) for r in sinks.read_snapshot(spark, f"{base}/state").collect()}
    assert state == {"http://a": ("housing", 1), "http://b": ("uncategorized", 2), "http://c": ("uncategorized", 2)}
    assert {r.url: r.content for r in sinks.read_snapshot(spark, f"{base}/pages").collect()}["http://b"] == "y"


def test_pipeline(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet").select("url", "html")
    kb = pipeline.run(pages, spark.createDataFrame([], STATE), Config(root_domain="example."), scorer=keyword_scorer({"the": "university news, press release or story"}))
    n = kb.pages.count()
    assert n > 0 and kb.state.count() == n and kb.files.count() == n
    assert kb.ranks.count() >= n and kb.index.count() > 0
    assert kb.files.filter("category = 'news'").count() > 0


def test_a_failed_write_leaves_the_version_before(spark, tmp_path, monkeypatch):
    base = f"file://{tmp_path}/t"
    one = spark.createDataFrame([(1,)], "v int")
    sinks.write_snapshot(one, base)
    (tmp_path / "t" / "v-000000000002").mkdir()  # as if another writer had come first
    monkeypatch.setattr(sinks, "_versions", lambda *_: [1])
    with pytest.raises(OSError):
        sinks.write_snapshot(spark.createDataFrame([(2,)], "v int"), base)
    assert [r.v for r in sinks.read_snapshot(spark, base).collect()] == [1]
    monkeypatch.undo()
    (tmp_path / "t" / "v-000000000002").rmdir()
    (tmp_path / "t" / "draft-x").mkdir()  # left by a writer that died
    assert [r.v for r in sinks.read_snapshot(spark, base).collect()] == [1]
    with pytest.raises(FileNotFoundError):
        sinks.read_snapshot(spark, f"file://{tmp_path}/none")


def test_missing_files_and_queues(spark, tmp_path):
    none = f"file://{tmp_path}/none"
    assert [f(spark, none).count() for f in (readers.read_pending, readers.read_blacklist, readers.read_ranks)] == [0, 0, 0]
    urls = spark.createDataFrame([(3, "b"), (1, "c"), (2, "b"), (0, "é")], "pos int, url string")
    sinks.write_pending(urls, f"file://{tmp_path}/queue")
    assert [r.url for r in readers.read_pending(spark, f"file://{tmp_path}/queue").collect()] == ["é", "c", "b", "b"]
    for part in (["x", "y\t"], ["z", "x"]):
        sinks.append_urls(spark.createDataFrame([(u,) for u in part], "url string"), f"file://{tmp_path}/black")
    assert sorted(r.url for r in readers.read_blacklist(spark, f"file://{tmp_path}/black").collect()) == ["x", "y", "z"]
    (tmp_path / "ranks.txt").write_text("1.5\tu\n2.5\tu\n")
    assert [tuple(r) for r in readers.read_ranks(spark, f"file://{tmp_path}/ranks.txt").collect()] == [("u", 2.5)]


def test_files_of_moved_pages_go(spark, tmp_path):
    md = spark.createDataFrame([("news", "a.md", "x"), ("events", "b.md", "y")], "category string, filename string, md string")
    sinks.write_markdown_files(md, f"file://{tmp_path}/kb")
    sinks.delete_files(md.filter("category = 'news'").union(spark.createDataFrame([("news", "no.md", "")], md.schema)), f"file://{tmp_path}/kb")
    assert not (tmp_path / "kb/news/a.md").exists() and (tmp_path / "kb/events/b.md").read_text() == "y"
