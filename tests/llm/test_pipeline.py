"""The pipeline against brute force over what its stages decide, and the registered queries against their SQL."""

import re

import pytest

import corpus_pipeline
from conftest import compare
from webloom.llm import registry

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, small, name):
    got, want = compare(spark, small, registry.queries()[name], registry.oracle_sql()[name])
    assert got == want


def test_columns_of_queries(spark, small):
    wanted = {
        "op2_sharding": "doc_id size text_crc32 law shard slot grown_shard",
        "op4_toxicity": "doc_id held_out score predicted",
        "op5_ngram_join": "doc_id n_shingles component_id",
        "op6_language_id": "doc_id held_out lang_pred score",
        "op7_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
        "op8_quality": "doc_id held_out score predicted",
        "op10_warc": "page_id payload_bytes payload_digest record_type refers_to",
    }
    for name, columns in wanted.items():
        assert registry.queries()[name](spark, small).columns == columns.split()


def test_pipeline_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    good = registry.op8_quality(spark, small).filter("predicted = 1")
    rows = {r.doc_id: r.text for r in docs.join(good, "doc_id").collect()}
    stage = dict(corpus_pipeline.STAGES)

    def ids(df):
        assert df.columns == docs.columns
        return sorted(r.doc_id for r in df.collect())

    one = stage["quality_filter"](spark, docs, small)
    assert ids(one) == sorted(rows)
    seen, kept = {}, []
    for d in sorted(rows):
        t = re.sub("[\x20\x09-\x0d]+", " ", rows[d])
        if seen.setdefault(t, d) == d:
            kept.append(d)
    two = stage["exact_copies"](spark, one, small)
    assert ids(two) == kept
    sets = {}
    for d in kept:
        w = re.findall("[^\x20\x09-\x0d]+", rows[d].translate(LOW))
        sets[d] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    top = {d: d for d in kept}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in kept:
        for b in kept:
            both = len(sets[a] & sets[b]) if a < b else 0
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                top[y] = x
    apart = [d for d in kept if find(d) == d]
    three = stage["near_copies"](spark, two, small)
    assert ids(three) == apart
    windows = set()
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    for r in spark.read.parquet(f"{small}/benchmark.parquet").collect():
        w = word.findall(r.text.translate(LOW))
        windows |= {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9))} if w else set()
    clean = []
    for d in apart:
        w = word.findall(rows[d].translate(LOW))
        if not any(tuple(w[i : i + k]) in windows for k in {len(x) for x in windows} for i in range(len(w) - k + 1)):
            clean.append(d)
    four = stage["benchmark_free"](spark, three, small)
    assert ids(four) == clean
    packed = stage["packed"](spark, four, small)
    assert sorted({r.doc_id for r in packed.collect()}) == clean
    whole = corpus_pipeline.run(spark, small)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, packed.collect()))


AWKWARD = "doc_id long, text string, lang string, source string, n_chars long, id string, sig long, n long, kept boolean, _digest string, items string, _text_digest string"


def awkward(spark, rows):
    return spark.createDataFrame([(i, t, None, None, None, "id", 7, None, True, "d", None, f"{i} {t}") for i, t in rows], AWKWARD)


def test_stages_take_awkward_rows(spark, small):
    long = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty"
    rows = [(0, "B"), (1, "A"), (1, "B"), (1, "a  b"), (None, "a b"), (None, None), (2, ""), (2, None), (None, None), (3, long), (None, long + " more"), (4, "word " * 40_000), (4, "word " * 40_000)]
    docs, stage = awkward(spark, rows), dict(corpus_pipeline.STAGES)
    for name, f in corpus_pipeline.STAGES[:-1]:
        assert f(spark, docs, small).columns == docs.columns, name
        assert f(spark, docs.limit(0), small).count() == 0, name
    kept = [(r.doc_id, r.text, r._text_digest) for r in stage["exact_copies"](spark, docs, small).collect()]
    assert sorted(re.sub(r"\s+", " ", t or "") for _, t, _ in kept) == sorted({re.sub(r"\s+", " ", t or "") for _, t in rows})
    assert {(0, "B"), (1, "A"), (1, "a  b"), (3, long)} <= {(i, t) for i, t, _ in kept} and all(d == f"{i} {t}" for i, t, d in kept)
    near = [(r.doc_id, r.text) for r in stage["near_copies"](spark, docs, small).collect()]
    want = [(0, "B"), (1, "a  b"), (None, None), (None, None), (2, ""), (2, None), (3, long), (4, "word " * 40_000), (1, "A")]  # rows without words all stay
    assert sorted(near, key=str) == sorted(want, key=str)
    assert stage["benchmark_free"](spark, docs, small).count() == len(rows)
    pieces = stage["packed"](spark, docs, small).collect()
    assert sum(r.start == 0 for r in pieces) == len(rows) and all(r.length <= 4096 for r in pieces)
    assert stage["packed"](spark, docs.limit(0), small).count() == 0


def test_whole_rows_go_to_workers_in_small_batches(spark, small):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    docs = awkward(spark, [(i, f"some words of row {i}") for i in range(3000)]).coalesce(1)

    def sizes(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    try:
        for name in ("quality_filter", "benchmark_free"):
            spark.conf.set(key, "10000")
            kept = dict(corpus_pipeline.STAGES)[name](spark, docs, small)
            seen = [r.n for r in docs.mapInArrow(sizes, "n long").collect()]
            assert sum(seen) == 3000 and max(seen) <= 1000, name
            assert kept.count() in (0, 3000), name  # texts that differ in a number score the same
            spark.conf.set(key, "100")  # fewer stay fewer
            dict(corpus_pipeline.STAGES)[name](spark, docs, small)
            assert spark.conf.get(key) == "100", name
    finally:
        spark.conf.set(key, before)
