"""Tokens, packing, counts and archives: round trips and brute force."""

import base64
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from webloom.llm import packing, token_counts, tokens, warc
from webloom.llm.common import string_buffers

DOCS = "doc_id long, text string, id string, start long, length string, cls int"
PATH = tokens.tokenizer_path()


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, "y", 2) for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def direct():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_pieces_encode_like_whole_texts(direct):
    random.seed(2)
    letters = "aAbzéÉçß×÷'’.,!-—  \n\t0123¹½<|>sStTlLdDmİΣςﬁ中🙂\x00́ _"
    known = tokens.PieceTokenizer(PATH, most=500)
    for k in range(60):
        texts = ["".join(random.choice(letters) for _ in range(random.randint(0, 40))) for _ in range(20)] + [None, ""]
        texts = [t and t.replace("|", "") for t in texts] if k % 3 else [*texts, "x<|endoftext|>y"]
        ids, at = known.encode(*string_buffers(pa.array(texts)))
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == [direct(t) for t in texts]


def test_packing_is_a_partition(spark, direct):
    rows = [(1, None), (2, ""), (3, "a b c"), (3, "a b c"), (None, "q"), (4, "word " * 9000), (5, "x1 " * 2047 + "x")] + [(10 + i, "tok " * (i * 37 % 1500)) for i in range(80)]
    got = packing.pack_documents(docs_of(spark, rows), keep_ids=True).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        assert 0 < r.length == len(r.ids) <= 4096
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for s in by_sequence.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    once = [(i, t) for i, t in rows if i != 3]
    for i, t in once:
        parts = sorted(by_doc[i], key=lambda r: r.start)
        want = [*direct(t), 2]
        assert [x for r in parts for x in r.ids] == want and {r.doc_tokens for r in parts} == {len(want)}
        assert [r.start for r in parts] == list(np.cumsum([0, *[r.length for r in parts]])[:-1])
    assert len(by_doc[3]) == 2
    total = sum(r.length for r in got)
    assert len(by_sequence) <= 1.1 * total / 4096 + 2


def test_packing_of_nothing(spark):
    assert packing.pack_documents(docs_of(spark, [])).count() == 0


def test_cutting_stock_serves_demand():
    rng = np.random.default_rng(1)
    for capacity in (7, 32, 64):
        demand = rng.integers(0, 60, capacity)
        plan, bound = packing.cutting_stock(demand, capacity)
        assert (sum(p * n for p, n in plan) == demand).all()
        assert all((p * np.arange(1, capacity + 1)).sum() <= capacity and n > 0 for p, n in plan)
        least = -(-(demand * np.arange(1, capacity + 1)).sum() // capacity)
        big = (demand * (np.arange(1, capacity + 1) * 2 > capacity)).sum()
        assert sum(n for _, n in plan) <= max(least, big) * 1.05 + 3
        assert (demand * np.arange(1, capacity + 1)).sum() / capacity <= bound <= sum(n for _, n in plan) + 1e-9
    assert packing.cutting_stock(np.zeros(5, np.int64), 5) == ([], 0.0)


def test_columns_come_within_the_gap_of_the_bound():
    rng = np.random.default_rng(2)
    demand = np.zeros(4096, np.int64)
    np.add.at(demand, np.minimum(4095, rng.lognormal(5.5, 1.2, 100_000).astype(int) // 16 * 16 + 15), 1)
    plan, bound = packing.cutting_stock(demand, 4096)
    assert sum(n for _, n in plan) <= bound * 1.002 + np.count_nonzero(demand) / 8


@pytest.mark.parametrize("text", [None, "a b", "a b c d e f g", "word " * 70])
def test_short_texts_leave_little_padding(spark, text):
    got = packing.pack_documents(spark.range(8192).select(F.col("id").alias("doc_id"), F.lit(text).cast("string").alias("text"))).select("sequence_id", "length", "doc_tokens").collect()
    whole = 4096 // got[0].doc_tokens  # documents in a sequence
    assert len(got) == 8192 and len({r.sequence_id for r in got}) <= -(-8192 // whole) * 1.02


def test_best_patterns_are_best():
    rng = np.random.default_rng(4)
    sizes = np.arange(1, 7)
    for _ in range(20):
        value = rng.random(6)
        best = max(sum(v * k for v, k in zip(value, ks, strict=True)) for ks in np.ndindex(13, 7, 5, 4, 3, 3) if sum((i + 1) * k for i, k in enumerate(ks)) <= 12)
        got, patterns = packing.best_patterns(sizes, value, 12)
        assert got == pytest.approx(best) and (patterns @ value).max() == pytest.approx(best)
        assert (patterns @ sizes <= 12).all()


def test_histogram_equals_brute_force(spark, direct):
    rows = [(1, None), (2, ""), (3, "a"), (3, "a"), (4, "a b"), (5, "word " * 700), (None, "é É")] + [(10 + i, "x " * (i % 7)) for i in range(30)]
    n = [len(direct(t)) for _, t in rows]
    want = {x: (n.count(x), sum(k <= x for k in n), sum(k >= x for k in n), sum(k for k in n if k <= x), sum(k for k in n if k >= x), sum(min(k, x) for k in n)) for x in set(n)}
    got = token_counts.length_histogram(docs_of(spark, rows)).collect()
    assert {r.n_tokens: (r.n_docs, r.docs_upto, r.docs_from, r.tokens_upto, r.tokens_from, r.truncated_tokens) for r in got} == want
    assert all(r.quantile == pytest.approx(r.docs_upto / len(n)) for r in got)
    assert token_counts.length_histogram(docs_of(spark, [])).count() == 0
    assert Counter(r.n_tokens for r in token_counts.document_lengths(docs_of(spark, rows)).collect()) == Counter(n)


# ---------------------------------------------------------------- WARC
PAGES = "page_id long, url string, html string, key string, file int"


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "k", 1) for r in rows], PAGES)


AWKWARD = [
    (1, "http://a.org/x", "same"), (2, None, "same"), (9, "http://a.org/x", "same"), (3, "", None), (4, "::bad", ""), (5, "http://é.org/" + "y" * 200, "z\r\n\r\n"), (6, "http://é.org/" + "y" * 200 + "2", "é" * 100_000),
    (7, "http://user@B.a.org:80/p?q=1#f", "WARC/1.1\r\n\r\n"), (7, "http://twice.org", "unlike"), (None, "http://none.org", "no id"), (8, "http://sp ace.org/\n", "x"),
]


def test_archive_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 2)
    rows = AWKWARD + [(100 + i, f"http://h{i % 5}.org/{i}", f"<p>{i % 9}</p>") for i in range(60)]
    archive = warc.write_archive(pages_of(spark, rows))
    assert archive.blocks > 10
    top = defaultdict(int)
    for i, _, h in rows:
        top[h or ""] = max(top[h or ""], i or 0)
    want = []
    for i, _, h in rows:
        raw = (h or "").encode()
        last = top[h or ""] or None
        revisit = i != last
        want.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if revisit else "response", last if revisit else None))
    assert sorted(map(tuple, warc.read_back(archive, pages_of(spark, rows)).collect()), key=str) == sorted(want, key=str)
    asked = pages_of(spark, [*rows, (0, "http://never.org/", "")]).select("url")
    got = warc.lookup(archive, asked).collect()
    of_key = defaultdict(set)
    for i, u, _ in rows:
        of_key[warc.url_key(u)].add(i)
    for u in {u for _, u, _ in rows} | {"http://never.org/"}:
        assert {r.page_id for r in got if r.url == u} == of_key.get(warc.url_key(u), set())


def test_records_parse():
    raw = warc.record(3, "http://a.org/", "é\r\n\r\nx".encode(), None)
    fields, http, payload = warc.parse_record(raw)
    assert payload == "é\r\n\r\nx".encode() and fields["warc-type"] == "response" and http.startswith(b"HTTP/1.1 200")
    fields, _, payload = warc.parse_record(warc.record(3, "http://a.org/", b"abc", 9))
    assert payload == b"" and fields["warc-type"] == "revisit" and fields["x-refers-to-page"] == "9"
    assert warc.url_key("http://user@B.a.org:80/p?q=1#f") == "org,a,b:80)/p?q=1#f"


def test_small_payloads_are_never_revisits(spark):
    got = warc.archive_pages(pages_of(spark, [(1, "u", "ab"), (2, "v", "ab"), (3, "w", "abc"), (4, "x", "abc")]), least_bytes=3).collect()
    assert {r.page_id: r.record_type for r in got} == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def test_archive_of_nothing(spark):
    archive = warc.write_archive(pages_of(spark, []))
    assert warc.read_back(archive, pages_of(spark, [(1, "http://a", "")])).count() == 0
    assert warc.lookup(archive, pages_of(spark, [(1, "http://a", "")])).count() == 0


def test_histogram_answers_any_limit(spark):
    docs = spark.createDataFrame([(i, "word " * (7 * i)) for i in range(9)], "doc_id long, text string")
    sizes = [r.n_tokens for r in token_counts.document_lengths(docs).collect()]
    limits = [0, 1, 10, max(sizes), max(sizes) + 1, 4096]
    got = token_counts.at_limits(token_counts.length_histogram(docs), limits).collect()
    assert sorted(r.n_tokens for r in got) == sorted(set(limits))
    for r in got:
        own = [x for x in sizes if x >= r.n_tokens]
        assert (r.docs_from, r.tokens_from, r.truncated_tokens) == (len(own), sum(own), sum(min(x, r.n_tokens) for x in sizes))
        assert abs(r.quantile - sum(x <= r.n_tokens for x in sizes) / len(sizes)) < 1e-12
    none = token_counts.at_limits(token_counts.length_histogram(docs.limit(0)), [5]).collect()
    assert [tuple(r) for r in none] == [(5, 0, 0, 0, None)]


def test_histogram_rows_of_limits_and_quantiles(spark):
    docs = spark.createDataFrame([(i, "word " * (7 * i)) for i in range(9)], "doc_id long, text string")
    sizes = sorted(r.n_tokens for r in token_counts.document_lengths(docs).collect())
    got = {r.n_tokens: r for r in token_counts.length_histogram(docs, limits=[1, sizes[3], 4096]).collect()}
    assert set(got) == {*sizes, 1, 4096} and got[1].n_docs == 0 and got[sizes[3]].n_docs == 1
    assert (got[1].docs_from, got[1].truncated_tokens, got[4096].docs_upto) == (8, 8, 9)
    shares = {r.share: r.n_tokens for r in token_counts.at_quantiles(token_counts.length_histogram(docs, limits=[1]), [0.1, 0.5, 1.0]).collect()}
    assert shares == {0.1: sizes[0], 0.5: sizes[4], 1.0: sizes[8]}
    empty = token_counts.length_histogram(docs.limit(0), limits=[5])
    assert [(r.n_tokens, r.n_docs, r.quantile) for r in empty.collect()] == [(5, 0, None)]
