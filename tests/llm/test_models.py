"""The learnt operators against brute force, one text at a time, on small tables."""

import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from webloom.llm import components, langid, quality, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, lang, "x", 1, 0.5) for i, t, lang in rows], DOCS)


# ---------------------------------------------------------------- language ID
def slots_of(text, bits=langid.BITS):
    form = re.sub(rb"[^a-z\x80-\xff]+", b" ", text.lower().encode() if text.isascii() else bytes(b + 32 if 65 <= b <= 90 else b for b in text.encode()))
    out = []
    for k in langid.ORDERS:
        for p in range(len(form) - k + 1):
            out.append(((int.from_bytes(form[p : p + k], "big") + (k << 56)) * 0x9E3779B97F4A7C15 % 2**64) >> (64 - bits))
    return out


def test_language_query_equals_brute_force(spark):
    rng = random.Random(3)
    words = {"aa": ["la", "El", "niño", "que"], "bb": ["the", "And", "of", "ing"], "cc": ["der", "Straße", "und", "ü"]}
    rows = [(i, ", ".join(rng.choice(words[k]) for _ in range(rng.randint(1, 9))), k if rng.random() < 0.9 else None) for i in range(120) for k in [rng.choice(list(words))]]
    rows += [(200, None, "aa"), (201, "", "aa"), (202, "12 !", "bb"), (203, "the", None), (None, "und der", "cc")]
    learn = [(t, k) for i, t, k in rows if i is not None and zlib.crc32(str(i).encode()) % 5 and k and t is not None]
    counts, prior = defaultdict(Counter), Counter()
    for t, k in learn:
        counts[k].update(slots_of(t))
        prior[k] += 1
    size = 1 << langid.BITS
    got = langid.language_id(docs_of(spark, rows)).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for i, t, _ in rows:
        r = by_id[i]
        assert r.held_out == (i is not None and zlib.crc32(str(i).encode()) % 5 == 0)
        if not t or not re.search(r"[^\W\d_]", t):
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        s = {k: math.log(prior[k] / len(learn)) + sum(math.log((counts[k][x] + 0.1) / (counts[k].total() + 0.1 * size)) for x in slots_of(t)) for k in sorted(prior)}
        best = max(s, key=s.get)
        share = 1 / sum(math.exp(v - s[best]) for v in s.values())
        assert r.lang_pred == best and r.score == pytest.approx(share, abs=1e-3)


def test_every_language_can_be_predicted(spark):
    names = [f"l{k:03d}" for k in range(300)]
    rows = [(j * 300 + k, f"{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k // 26)}q " * 4, names[k]) for j in range(3) for k in range(300)]
    model = langid.train(docs_of(spark, rows), langid.crc_bucket("doc_id", 5) != 9)
    assert len(model.languages) == 300 and model.matrix.size <= 1.1 * langid.MATRIX_CELLS
    got = {r.doc_id: r.lang_pred for r in langid.identify(docs_of(spark, rows), model).collect()}
    assert sum(got[i] == lang for i, _, lang in rows) >= 0.95 * len(rows)


# ---------------------------------------------------------------- quality
def test_quality_query_equals_brute_force(spark):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(300):
        good = rng.random() < 0.6
        rows.append((i, " ".join(rng.choice(["Some", "plain", "words", "here."] if good else ["BUY", "!!!", "$$$", "now", "now"]) for _ in range(rng.randint(3, 40))), "en"))
        labels.append((i, int(good)))
    rows += [(400, None, None), (401, "", None), (402, "word " * 30_000, None), (None, "x", None)]
    labels += [(None, 1), (0, None), (1, 7)]
    learnt = [(t, y) for i, y in labels if i is not None and y in (0, 1) and zlib.crc32(str(i).encode()) % 4 != 2 for j, t, _ in rows if j == i]

    def stats(text):
        raw = np.frombuffer((text or "").encode(), np.uint8)
        return quality.statistics(raw, np.array([0, len(raw)]))[0].astype(np.float32).astype(np.float64)

    x, y = np.array([stats(t) for t, _ in learnt]), np.array([y for _, y in learnt], float)
    order = np.lexsort(x.T)
    trees = quality.fit_trees(x[order], y[order])

    def walk(row):
        total = trees.base
        for root in trees.root.tolist():
            node = root
            while trees.left[node] != node:
                node = trees.left[node] if row[trees.feature[node]] <= trees.threshold[node] else trees.right[node]
            total += trees.value[node]
        return 1 / (1 + math.exp(-total))

    table = spark.createDataFrame(labels, "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.quality_classifier(docs_of(spark, rows), table).collect()}
    assert len(got) == len(rows)
    for i, t, _ in rows:
        assert got[i].score == pytest.approx(walk(stats(t)), abs=1e-9)
        assert got[i].predicted == int(got[i].score >= 0.7) and got[i].held_out == (i is not None and zlib.crc32(str(i).encode()) % 4 == 2)


# ---------------------------------------------------------------- toxicity
def best_reading(token, model):
    """The likeliest reading of a short token: every path through the lattice is tried."""
    steps = []
    for m in re.finditer(r"(.)\1*", token, re.S):
        char, n = m[1], len(m[0])
        if char.isascii() and char.isalpha():
            arcs = [(char, 0.0 if n == 1 else toxicity._RUN)] + [(char * 2, 0.0 if n == 2 else toxicity._RUN)] * (n > 1)
        else:
            arcs = [a for c in toxicity.STANDS_FOR.get(char, "") for a in [(c, toxicity._STAND)] + [(c * 2, toxicity._STAND)] * (n > 1)]
            if char in toxicity.SEPARATORS:
                arcs += [("", toxicity._SKIP), (" ", toxicity._BREAK)]
            else:
                arcs += [(" ", toxicity._KEEP_SIGN if arcs else toxicity._BREAK)] + [("", toxicity._KEEP_SIGN)] * (not arcs)
        steps.append(arcs)
    best = (-math.inf, "")
    for path in itertools.product(*steps):
        score, x, y = sum(c for _, c in path), 0, 0
        for c in "".join(o for o, _ in path):
            z = 0 if c == " " else ord(c) - 96
            if z == 0 and y == 0:
                continue
            score += model[x, y, z]
            x, y = (0, 0) if z == 0 else (y, z)
        score += model[x, y, 0] if y else 0
        best = max(best, (score, "".join(o for o, _ in path)))
    return best[0], best[1]


def test_decoding_finds_the_likeliest_path():
    rng = random.Random(7)
    corpus = toxicity.trigram_counts(np.frombuffer(b"the words of some text are told from those of others " * 20, np.uint8), np.array([0, 1060]))
    model = toxicity.language_model(corpus, ["idiot", "scum"])
    for _ in range(200):
        token = "".join(rng.choice("idotscum1034$!|.-_ +") * rng.choice([1, 1, 1, 2, 3]) for _ in range(rng.randint(1, 6)))
        assert toxicity.decode(token, model).split() == best_reading(token, model)[1].split(), token


def test_stems_end_between_characters():
    assert toxicity.with_stems("ääää") == ["ääää", "ää*", "äää*"]
    assert toxicity.with_stems("aäää") == ["aäää", "aää*"]
    assert toxicity.with_stems("abcdef") == ["abcdef", "abcd*", "abcde*"]


# ---------------------------------------------------------------- components
def test_components_of_a_long_path_and_of_stars(spark):
    path = spark.range(3000).selectExpr("id a", "id + 1 b")
    star = spark.range(5000, 6000).selectExpr("4999L a", "id b").union(spark.range(7000, 7400).selectExpr("id a", "9000L b"))
    odd = spark.createDataFrame([(10_000, 10_000), (None, 5), (10_001, 10_002), (10_002, 10_001), (10_001, 10_002)], "a long, b long")
    got = components.components(path.union(star).union(odd)).collect()
    roots = defaultdict(set)
    for r in got:
        roots[r.root].add(r.node)
    assert sorted(map(len, roots.values())) == [2, 401, 1001, 3001] and len(got) == len({r.node for r in got})
    assert components.components(odd.limit(1)).count() == 0
