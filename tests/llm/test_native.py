"""Exact dedup and sharding against brute force, with awkward inputs."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from webloom.llm import exact_dedup, sharding

DOCS = "doc_id long, text string, lang string, _id string, size int, kept string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, None, "x", 1, "y") for i, t in rows], DOCS)


def normal(t):
    return re.sub("[\x20\x09-\x0d]+", " ", t or "")


AWKWARD = [(5, "a  b"), (3, "a\tb"), (9, "a b"), (1, None), (2, ""), (7, " "), (8, "\n"), (4, "A b"), (6, "x" * 300_000), (10, "x" * 300_000), (11, "a b"), (12, "é\r\n"), (12, "é\n"), (None, "a b"), (None, "alone")]


def test_exact_dedup_equals_brute_force(spark):
    rows = AWKWARD + [(100 + i, f"copy {i % 3}") for i in range(60)]
    got = exact_dedup.exact_dedup(docs_of(spark, rows)).collect()
    groups = defaultdict(list)
    for i, t in rows:
        groups[normal(t)].append(i)
    want = Counter()
    for i, t in rows:
        ids = groups[normal(t)]
        want[(i, min((x for x in ids if x is not None), default=None), len(ids), hashlib.sha256(normal(t).encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept.values()) == {1} and len(kept) == len(groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


@pytest.mark.parametrize(("runs", "fan_in"), [(1, 8), (7, 2), (64, 3)])
def test_any_tree_gives_the_same(spark, runs, fan_in):
    docs = docs_of(spark, [(i, f"t{i % 5}") for i in range(40)])
    assert sorted(map(tuple, exact_dedup.exact_dedup(docs, runs=runs, fan_in=fan_in).collect())) == sorted(map(tuple, exact_dedup.exact_dedup(docs).collect()))


def test_empty_table(spark):
    assert exact_dedup.exact_dedup(docs_of(spark, [])).count() == 0
    assert sharding.shard_documents(docs_of(spark, [])).count() == 0


def test_drop_keeps_one_row_of_each_text(spark):
    docs = docs_of(spark, AWKWARD)
    left = exact_dedup.drop_exact_copies(docs)
    assert left.columns == docs.columns
    texts = [normal(r.text) for r in left.collect()]
    assert sorted(texts) == sorted({normal(t) for _, t in AWKWARD} - {"a b"} | {"a b"} | set()) or Counter(texts)["a b"] == 2


def test_drop_keeps_exactly_one_row_of_each_text(spark):
    rows = [*AWKWARD, (None, "only null"), (None, "only  null"), (20, "p"), (21, "p"), (21, "unlike")]
    left = exact_dedup.drop_exact_copies(docs_of(spark, rows))
    assert left.columns == docs_of(spark, []).columns
    got = [(r.doc_id, normal(r.text)) for r in left.collect()]
    assert sorted(t for _, t in got) == sorted({normal(t) for _, t in rows})
    assert {(3, "a b"), (20, "p"), (21, "unlike"), (None, "only null")} <= set(got)


def check_shards(rows, got, shards):
    assert len(got) == len(rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    count = Counter(r.shard for r in got)
    sizes = [count[s] for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and set(count) <= set(range(shards))
    for s in range(shards):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(count[s]))
    assert {r.law for r in got} == {"rows"} and all(r.grown_shard is None for r in got)


def cut_groups(got):
    at = defaultdict(set)
    n = Counter()
    for r in got:
        at[(r.text_crc32, r.size)].add(r.shard)
        n[(r.text_crc32, r.size)] += 1
    return {k: (n[k], len(v)) for k, v in at.items() if len(v) > 1}


def test_shards_are_even_and_keep_groups(spark):
    rows = AWKWARD + [(1000 + i, f"pair {i // 2}") for i in range(300)] + [(2000 + i, f"single {i}") for i in range(200)]
    got = sharding.shard_documents(docs_of(spark, rows)).collect()
    check_shards(rows, got, 8)
    assert not cut_groups(got)


def test_a_group_larger_than_a_shard(spark):
    rows = [(i, "hot") for i in range(200)] + [(1000 + i, f"pair {i // 2}") for i in range(200)] + [(3000 + i, f"s {i}") for i in range(200)]
    got = sharding.shard_documents(docs_of(spark, rows)).collect()
    check_shards(rows, got, 8)
    cut = cut_groups(got)
    assert sum(1 for n, _ in cut.values() if n == 2) <= 5
    assert max(k for _, k in cut.values()) <= 5  # 200 of 75 a shard need three


@pytest.mark.parametrize(("pairs", "singles"), [(1600, 0), (1520, 160)])
def test_pairs_in_full_shards_are_exchanged(spark, pairs, singles):
    rows = [(i, f"pair {i % pairs}") for i in range(2 * pairs)] + [(10_000 + i, f"single {i}") for i in range(singles)]
    got = sharding.shard_documents(docs_of(spark, rows)).collect()
    check_shards(rows, got, 8)
    assert not cut_groups(got)


def test_flows_exchange_rows_between_full_shards():
    assert sharding.flows([[0, 5], [3, 0]], [10, 10], [10, 10]) == [[0, 3], [3, 0]]
    assert sharding.flows([[0, 2, 0], [0, 0, 4], [3, 0, 0]], [9, 9, 9], [9, 9, 9]) == [[0, 2, 0], [0, 0, 2], [2, 0, 0]]
    assert sharding.flows([[0, 5], [0, 0]], [12, 6], [9, 9]) == [[0, 3], [0, 0]]


def test_groups_are_joined_in_cycles():
    parts = {b"a": {0: 1, 1: 1}, b"b": {1: 1, 2: 1}, b"c": {0: 1, 2: 1}, b"d": {3: 2, 4: 1}}
    moves = sharding.joined_groups(parts, [5] * 5, [5] * 5)
    assert sorted({g for g, _, _ in moves}) == [b"a", b"b", b"c"]
    assert all(sum(n for _, s, n in moves if s == shard) == 0 for shard in range(5))
    assert not {g for g, _, _ in moves} - set(parts) and len(moves) == 6


def test_cut_groups_are_packed_anew():
    parts = {b"a": {0: 3, 1: 2}, b"b": {1: 3, 2: 2}, b"c": {0: 2, 2: 3}}
    moves = sharding.joined_groups(parts, [5, 5, 5], [5, 5, 5])
    rows = {g: dict(p) for g, p in parts.items()}
    for g, s, n in moves:
        rows[g][s] = rows[g].get(s, 0) + n
    whole = [{s: n for s, n in p.items() if n} for p in rows.values()]
    assert sorted(s for p in whole for s in p) == [0, 1, 2] and all(n == 5 for p in whole for n in p.values())


@pytest.mark.parametrize("n", [1, 5, 8, 17])
def test_few_rows(spark, n):
    rows = [(i, "same" if i % 2 else f"{i}") for i in range(n)]
    check_shards(rows, sharding.shard_documents(docs_of(spark, rows)).collect(), 8)


def test_levels_are_sorted_runs(spark):
    rows = exact_dedup.digests(spark.createDataFrame([(i, f"t{i % 7}") for i in range(100)], "doc_id long, text string"), "doc_id", "text")
    levels = exact_dedup.tree_merge(rows.withColumn("_run", F.col("_id") % 64), 8, 64)
    assert len(levels) == 3
    plan = levels[-1]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") >= 2 and plan.count("Window [row_number()") >= 2 and "Python" not in plan  # the head of each stretch of a sorted run
    got = levels[-1].select("_low", "_n").collect()
    assert sorted(tuple(r) for r in got) == [(i, 15 if i < 2 else 14) for i in range(7)]
