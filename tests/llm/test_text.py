"""Decontamination, the n-gram join, language and quality and toxicity, on small cases and by brute force."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from webloom.llm import components, decontaminate, langid, ngram_join, quality, toxicity
from webloom.llm.common import row_slices, string_buffers

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
CHUNK = re.compile("[^\x20\x09-\x0d]+")
DOCS = "doc_id long, text string, lang string, id string, n long, score double"


def docs_of(spark, rows):
    return spark.createDataFrame([(r[0], r[1], r[2] if len(r) > 2 else None, "x", 1, 0.5) for r in rows], DOCS)


# ---------------------------------------------------------------- decontamination
def hits(text, items, size=10):
    w = WORD.findall((text or "").translate(LOW))
    hit, found, windows = set(), set(), {}
    for item, t in items:
        b = WORD.findall((t or "").translate(LOW))
        k = min(size, len(b))
        for p in range(len(b) - k + 1) if b else []:
            windows.setdefault(tuple(b[p : p + k]), set()).add(str(item))
    for k in {len(x) for x in windows}:
        for q in range(len(w) - k + 1):
            got = windows.get(tuple(w[q : q + k]))
            if got:
                hit |= set(range(q, q + k))
                found |= got
    return len(w), len(hit), sorted(found)


@pytest.mark.parametrize("pass_bytes", [decontaminate.PASS_BYTES, 150])
def test_contamination_equals_brute_force(spark, pass_bytes):
    random.seed(5)
    vocabulary = ["a", "b", "Ça", "x1", "the", "é", "中", "z" * 30]
    items = [(i, " ".join(random.choice(vocabulary) for _ in range(n))) for i, n in enumerate([1, 2, 9, 10, 11, 25, 40])] + [(100, None), (101, "..!"), (102, "The, the"), (103, "the THE")]
    rows = [(1, None), (2, ""), (3, "!!"), (4, "the-the"), (4, "the-the"), (None, "a b")]
    for i in range(40):
        words = [random.choice(vocabulary) for _ in range(random.randint(0, 60))]
        if i % 2:
            at = random.randint(0, len(words))
            words[at:at] = random.choice(items[:7])[1].upper().split()
        rows.append((10 + i, random.choice([" ", ", ", "\n"]).join(words)))
    rows.append((99, "a b " * 100_000 + items[6][1]))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(decontaminate.contamination(docs_of(spark, rows), bench, pass_bytes=pass_bytes).collect(), key=lambda r: (r.doc_id is None, r.doc_id))
    for r, (i, t) in zip(got, sorted(rows, key=lambda x: (x[0] is None, x[0])), strict=True):
        n, hit, found = hits(t, items)
        assert (r.doc_id, r.n_words, r.n_hit, r.n_items, r.contaminated, r.items) == (i, n, hit, len(found), hit > 0, found)
        assert r.items_sha256 == hashlib.sha256(",".join(found).encode()).hexdigest()
    assert "6" in next(r for r in got if r.doc_id == 99).items
    clean = decontaminate.drop_contaminated(docs_of(spark, rows), bench, pass_bytes=pass_bytes)
    assert sorted((r.doc_id for r in clean.collect()), key=str) == sorted((r.doc_id for r in got if not r.contaminated), key=str)


def test_contamination_of_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(docs_of(spark, []), none).count() == 0
    assert [r.contaminated for r in decontaminate.contamination(docs_of(spark, [(1, "a b")]), none).collect()] == [False]
    assert decontaminate.drop_contaminated(docs_of(spark, [(1, "a b")]), none).count() == 1


# ---------------------------------------------------------------- n-gram join
def brute_components(rows):
    sets = []
    for _, t in rows:
        w = CHUNK.findall((t or "").translate(LOW))
        sets.append(frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset())
    top = list(range(len(rows)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                top[find(i)] = find(j)
    low = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        low[find(i)].append(d)
    return sorted((d, len(sets[i]), min(low[find(i)])) for i, (d, _) in enumerate(rows))


def similar_rows(seed, families, copies, own=0):
    random.seed(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    rows, n = [], 0
    for _ in range(families):
        base = [random.choice(vocabulary) for _ in range(random.choice([5, 20, 60, 120]))]
        for _ in range(copies):
            w = list(base)
            for _ in range(random.randint(0, 3)):
                w[random.randrange(len(w))] = random.choice(vocabulary)
            w += [random.choice(vocabulary) for _ in range(random.randint(0, own))]
            rows.append((n, " ".join(w)))
            n += 1
    return rows


def test_components_equal_brute_force(spark):
    rows = similar_rows(1, 12, 8, own=10) + [(1000, None), (1001, ""), (1002, " \n"), (1003, "one"), (1004, "ONE"), (1005, "one two"), (1006, "a b c d e"), (1007, "a b c d e f"), (1008, "x " * 4000), (1009, "X\t" * 4000)]
    got = sorted(tuple(r) for r in ngram_join.ngram_components(docs_of(spark, rows)).collect())
    assert got == brute_components(rows)


def test_components_of_a_large_family_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "LONG_COLUMN", 4)
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", 7)
    monkeypatch.setattr(ngram_join, "FREQUENT", 3)
    rows = similar_rows(2, 3, 45, own=14)
    got = sorted(tuple(r) for r in ngram_join.ngram_components(docs_of(spark, rows)).collect())
    assert got == brute_components(rows)
    got = sorted(tuple(r) for r in ngram_join.ngram_components(docs_of(spark, rows), turns=0).collect())
    assert got == brute_components(rows)


def test_components_of_repeats_and_nothing(spark):
    assert ngram_join.ngram_components(docs_of(spark, [])).count() == 0
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (None, "q r s")]
    got = [tuple(r) for r in ngram_join.ngram_components(docs_of(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted([(1, 2, 1), (1, 2, 1), (None, 2, 1), (None, 1, None)], key=str)


def test_one_row_of_each_component_stays_whatever_the_ids(spark):
    long = "a b c d e f g h i j k l m n o p q r s t u v w x y z"
    rows = [(1, long), (None, long + " end"), (2, long), (2, "quite another text of seven words"), (None, "q r s"), (None, "Q  r s"), (3, "x y"), (3, "X y"), (4, ""), (None, None)]
    left = ngram_join.keep_one_of_each(docs_of(spark, rows))
    assert left.columns == docs_of(spark, []).columns
    got = sorted(((r.doc_id, (r.text or "").lower().split()) for r in left.collect()), key=str)
    want = [(1, long.split()), (2, "quite another text of seven words".split()), (None, ["q", "r", "s"]), (3, ["x", "y"]), (4, []), (None, [])]
    assert got == sorted(want, key=str)


def test_connected_components(spark):
    random.seed(7)
    links = [(random.randrange(200), random.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 420)] + [(500, k) for k in range(501, 560)]
    got = dict(components.components(spark.createDataFrame(links, "a long, b long")).collect())
    top = {}

    def find(x):
        while top.setdefault(x, x) != x:
            x = top[x]
        return x

    for a, b in links:
        top[find(a)] = find(b)
    nodes = [x for a, b in links if a != b for x in (a, b)]
    same = {(find(x), got[x]) for x in nodes}
    assert len(same) == len({a for a, _ in same}) == len({b for _, b in same}) and set(got) == set(nodes)


# ---------------------------------------------------------------- language
def test_language(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    got = {r.doc_id: r for r in langid.language_id(docs).collect()}
    held = [(r.lang, got[r.doc_id].lang_pred) for r in docs.collect() if got[r.doc_id].held_out]
    assert sum(a == b for a, b in held) >= 0.95 * len(held) > 0
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_of_awkward_texts(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the and of", "en"), ("der und die", "de")] * 20)] + [(100, None, "en"), (101, "12 !?", None), (102, "", "de"), (103, "THE AND", None), (103, "THE AND", None), (None, "der und", None), (104, "the " * 200_000, None)]
    got = [(r.doc_id, r.lang_pred) for r in langid.language_id(docs_of(spark, rows)).collect()]
    assert len(got) == len(rows)
    one = dict(got)
    assert one[100] == one[101] == one[102] == "und" and one[103] == one[104] == "en" and one[None] == "de"
    assert [r.lang_pred for r in langid.language_id(docs_of(spark, [(1, "abc")])).collect()] == ["und"]
    assert langid.language_id(docs_of(spark, [])).count() == 0


def test_slots_do_not_reach_into_the_next_row():
    both, at = langid.slots(*string_buffers(pa.array(["ab", None, "cd e"])))
    alone = [langid.slots(*string_buffers(pa.array([t], pa.string())))[0].tolist() for t in ("ab", "", "cd e")]
    assert [both[at[i] : at[i + 1]].tolist() for i in range(3)] == alone


# ---------------------------------------------------------------- quality
def test_quality(spark, small):
    docs, labels = spark.read.parquet(f"{small}/documents.parquet"), spark.read.parquet(f"{small}/labels.parquet")
    got = {r.doc_id: r for r in quality.quality_classifier(docs, labels).collect()}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())
    held = [(r.quality, got[r.doc_id].predicted) for r in labels.collect() if got[r.doc_id].held_out]
    assert sum(a == b for a, b in held) >= 0.85 * len(held) > 0


def test_quality_of_awkward_input(spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (3, 7)], "doc_id long, quality int")
    rows = [(1, "a b"), (2, None), (3, ""), (4, "x" * 3_000_000), (4, "\x00"), (None, "z")]
    got = quality.quality_classifier(docs_of(spark, rows), labels).collect()
    assert len(got) == len(rows) and len({r.score for r in got if r.doc_id in (2, 3)}) == 1
    assert quality.quality_classifier(docs_of(spark, []), labels).count() == 0
    assert len(quality.quality_classifier(docs_of(spark, rows), labels.limit(0)).collect()) == len(rows)
    assert quality.keep_good(docs_of(spark, rows), labels).columns == docs_of(spark, rows).columns


def test_trees_learn_and_walk():
    rng = np.random.default_rng(0)
    x = rng.random((2000, 5))
    y = ((x[:, 1] > 0.4) & (x[:, 3] < 0.7)).astype(float)
    trees = quality.fit_trees(x, y)
    assert ((trees.score(x) > 0.5) == y).mean() > 0.99

    def walk(row):
        total = trees.base
        for i in trees.root.tolist():
            while trees.left[i] != i:
                i = trees.left[i] if row[trees.feature[i]] <= trees.threshold[i] else trees.right[i]
            total += trees.value[i]
        return 1 / (1 + np.exp(-total))

    assert np.allclose([walk(r) for r in x[:50]], trees.score(x[:50]))


def test_statistics_are_of_each_row_alone():
    texts = ["One two two.", None, "A|B\nC!! d", "", "x" * 5000, "é É"]
    data, offsets = string_buffers(pa.array(texts))
    whole = quality.statistics(data, offsets)
    for i, t in enumerate(texts):
        assert np.allclose(whole[i], quality.statistics(*string_buffers(pa.array([t], pa.string())))[0])


# ---------------------------------------------------------------- toxicity
@pytest.fixture(scope="module")
def scorer(spark):
    random.seed(0)
    clean = ["the", "and", "there", "with", "water", "stone", "little", "green"]
    rows, labels = [], []
    for i in range(600):
        w = [random.choice(clean) for _ in range(20)]
        if i % 4 == 0:
            w[random.randrange(20)] = random.choice(["idiot", "moron", "scum"])
        rows.append((i, " ".join(w)))
        labels.append((i, int(i % 4 == 0)))
    from pyspark.sql import functions as F

    return toxicity.train(docs_of(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int"), F.lit(True))


@pytest.mark.parametrize("text", ["an idiot", "1d10t", "an i d i o t here", "idiooot", "I.D.I.O.T", "id-i_ot!!", "m0r0n", "$cum", "ïdïöt", "M O R O N", "(idiot)", "x,scum"])
def test_disguised_words_are_found(scorer, text):
    assert scorer.score(*string_buffers(pa.array([text, "water"])))[0] > 0.5


@pytest.mark.parametrize("text", [None, "", "water and stone", "a b c d e", "12 34!", "http://x.y/z", "id 10", "!!!", "w@ter", "thhhere", "x" * 2_500_000])
def test_clean_texts_are_left_alone(scorer, text):
    assert scorer.score(*string_buffers(pa.array([text], pa.string())))[0] < 0.5


@pytest.mark.parametrize("text", ["i d i o t!", "an i d i o t?", "(i d i o t)", '"i d i o t"', "s c u m!", "id iot", "an id iot here", "mo r on"])
def test_spaced_words_with_marks_and_in_part_are_found(scorer, text):
    assert scorer.score(*string_buffers(pa.array([text, "water"])))[0] > 0.5


@pytest.mark.parametrize("text", ["c l a s s i c", "w a t e r!", "wa ter", "the more on with", "an id", "st one and gr een"])
def test_clean_spaced_texts_are_left_alone(scorer, text):
    assert scorer.score(*string_buffers(pa.array([text], pa.string())))[0] < 0.5


@pytest.mark.parametrize("text", ["x,1d10t", "you/m0r0n", "1d10t?yes", "no-m0r0n-yes", "there.$cum", "1d10t)m", "id?iot", "«1d10t»", "idi0t…no", "hi.1diot", "there,1d10t,water"])
def test_glued_disguised_words_are_found(scorer, text):
    assert scorer.score(*string_buffers(pa.array([text, "water"])))[0] > 0.5


@pytest.mark.parametrize("text", ["c.l.a.s.s.i.c", "x,w4ter", "st0ne?yes", "id,10", "10,20;30", "water…gr33n"])
def test_clean_glued_texts_are_left_alone(scorer, text):
    assert scorer.score(*string_buffers(pa.array([text], pa.string())))[0] < 0.5


def test_a_telling_word_is_found_in_a_large_vocabulary(spark):
    from pyspark.sql import functions as F

    shared = " ".join(f"{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k // 676 % 26)}vwxyz" for k in range(8000))
    rows = [(i, shared) for i in range(20)] + [(20 + i, shared + (" scum" if i < 10 else "")) for i in range(20)] + [(100 + i, shared) for i in range(20)]
    labels = [(i, int(20 <= i < 30)) for i, _ in rows]
    got = toxicity.train(docs_of(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int"), F.lit(True))
    assert got.words == ["scum"]


def test_every_mark_the_lattice_drops_is_dropped_from_the_skeleton(scorer):
    for char in "?)\"#%&=^>}]€«»…¿•→★、。🙂":
        hidden = f"mor{char}n" if char == "€" else f"id{char}iot"
        form = toxicity.skeletons(*string_buffers(pa.array([hidden])))[0].tobytes()
        assert form == (b"moren" if char == "€" else b"idiot"), char


def test_decode_is_viterbi(scorer):
    assert toxicity.decode("1d10t", scorer.model) == "idiot"
    assert toxicity.decode("s c u m", scorer.model) == "scum"


def test_toxicity(spark, small):
    docs, labels = spark.read.parquet(f"{small}/documents.parquet"), spark.read.parquet(f"{small}/labels.parquet")
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert toxicity.toxicity(docs_of(spark, []), labels).count() == 0
    assert toxicity.toxicity(docs_of(spark, [(1, None), (1, "x"), (None, "y")]), labels.limit(0)).count() == 3


def test_row_slices_cover_all_rows():
    offsets = np.array([0, 5, 5, 30, 31, 100])
    assert [x for i, j in row_slices(offsets, 10) for x in range(i, j)] == list(range(5))
