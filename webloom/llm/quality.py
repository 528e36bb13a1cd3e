"""Quality classifier: histogram gradient-boosted trees over statistics of the text.

Statistics are computed on the bytes of whole texts, many at a time.  The trees are
grown on the driver from the statistics of a bounded sample of labelled rows: each
statistic is binned by quantiles, gradients and Hessians are summed by bin, and
the best split of each node is read off the sums.  The trees are flattened into
arrays (feature, threshold, children, leaf value), which is all that executors
need; they walk all rows of a batch down all levels at once.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webloom.llm.bytewords import LOWER, NOT_BLANK, byte_classes, span_hashes, word_spans
from webloom.llm.common import clear_worker_caches, crc_bucket, lean, row_slices, small_batches, string_buffers

#: Labelled rows that the trees are fitted on, at most.
SAMPLE_ROWS = 20_000
#: Score from which a row is predicted to be of good quality.
THRESHOLD = 0.7

_COUNTED = {
    "upper": byte_classes(lambda b: 0x41 <= b <= 0x5A),
    "lower": byte_classes(lambda b: 0x61 <= b <= 0x7A),
    "digit": byte_classes(lambda b: 0x30 <= b <= 0x39),
    "wide": byte_classes(lambda b: b >= 0x80),
    "stop": byte_classes(lambda b: b in b".?"),
    "comma": byte_classes(lambda b: b in b",;:"),
    "shout": byte_classes(lambda b: b == 0x21),
    "bar": byte_classes(lambda b: b == 0x7C),
    "symbol": byte_classes(lambda b: b in b"#$%&*+/<=>@\\^_`{}~[]"),
    "line": byte_classes(lambda b: b == 0x0A),
}
FEATURES = [
    "log_bytes", "log_words", "word_bytes", "word_spread", "longest_word",
    *[f"{k}_share" for k in _COUNTED],
    "shout_per_word", "bar_per_word", "symbol_per_word", "stop_per_word", "capital_words", "upper_words",
    "distinct_words", "top_word", "repeats_next", "repeats_second", "short_words", "bytes_per_line",
]


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of :data:`FEATURES` for each text."""
    n = len(offsets) - 1
    size = np.diff(offsets).astype(np.float64)
    starts, ends, first = word_spans(data, offsets, NOT_BLANK)
    words = np.diff(first)
    some = np.maximum(words, 1)

    def by_row(values: np.ndarray) -> np.ndarray:
        """Sums over the words of each row."""
        return np.diff(np.concatenate([[0], np.cumsum(values, dtype=np.float64)])[first])

    length = (ends - starts).astype(np.float64)
    mean = by_row(length) / some
    spread = np.sqrt(np.maximum(by_row(length * length) / some - mean * mean, 0))
    longest = np.zeros(n)
    held = words > 0
    if len(length):
        longest[held] = np.maximum.reduceat(length, first[:-1][held])
    row = np.repeat(np.arange(n), words)
    counts = {}
    for k, table in _COUNTED.items():
        counts[k] = np.diff(np.concatenate([[0], np.cumsum(table[data], dtype=np.int64)])[offsets]).astype(np.float64)
    upper = _COUNTED["upper"][data]
    capital = upper[starts] if len(starts) else np.zeros(0)
    ups = np.concatenate([[0], np.cumsum(upper)])
    lows = np.concatenate([[0], np.cumsum(_COUNTED["lower"][data])])
    shouted = ((ups[ends] - ups[starts]) >= 2) & (lows[ends] == lows[starts]) if len(starts) else np.zeros(0)
    h = span_hashes(LOWER[data], starts, ends)
    next_ = np.zeros(len(h))
    second = np.zeros(len(h))
    if len(h) > 1:
        next_[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    if len(h) > 2:
        second[2:] = (h[2:] == h[:-2]) & (row[2:] == row[:-2])
    distinct, top = np.zeros(n), np.zeros(n)
    if len(h):
        order = np.lexsort((h, row))
        hs, rs = h[order], row[order]
        new = np.ones(len(h), bool)
        new[1:] = (hs[1:] != hs[:-1]) | (rs[1:] != rs[:-1])
        at = np.flatnonzero(new)
        run = np.diff(np.concatenate([at, [len(h)]]))
        distinct = np.bincount(rs[at], minlength=n).astype(np.float64)
        np.maximum.at(top, rs[at], run)
    bytes_ = np.maximum(size, 1)
    letters = np.maximum(counts["upper"] + counts["lower"], 1)
    shares = [counts[k] / (letters if k == "upper" else bytes_) for k in _COUNTED]
    out = [
        np.log1p(size), np.log1p(words), mean, spread, np.minimum(longest, 1000),  # a word of more bytes counts as one of a thousand
        *shares,
        counts["shout"] / some, counts["bar"] / some, counts["symbol"] / some, counts["stop"] / some, by_row(capital) / some, by_row(shouted) / some,
        distinct / some, top / some, by_row(next_) / some, by_row(second) / some, by_row(length <= 3) / some, size / (counts["line"] + 1),
    ]
    return np.column_stack(out)


@dataclasses.dataclass
class Trees:
    """A boosted ensemble as flat arrays; node i of tree t is at ``root[t] + i``, a leaf is its own child."""

    base: float
    root: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of statistics."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.root.tolist():
            node = np.full(len(x), root)
            for _ in range(self.depth):
                low = x[rows, self.feature[node]] <= self.threshold[node]
                node = np.where(low, self.left[node], self.right[node])
            total += self.value[node]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fit_trees(x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 64, smooth: float = 1.0, least: int = 20) -> Trees:
    """Fit the ensemble to statistics ``x`` and labels ``y`` by logistic loss."""
    p = float(np.clip(y.mean(), 0.01, 0.99)) if len(y) else 0.5
    base = float(np.log(p / (1 - p)))
    f = x.shape[1]
    cuts = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, bins + 1)[1:-1])) if len(x) else np.zeros(0) for k in range(f)]
    code = np.column_stack([np.searchsorted(cuts[k], x[:, k], "left") for k in range(f)]) if len(x) else np.zeros((0, f), int)
    width = bins + 1
    flat = code + np.arange(f) * width
    nodes: dict[str, list] = {k: [] for k in ("feature", "threshold", "left", "right", "value")}
    roots, margin = [], np.full(len(y), base)

    def new_node() -> int:
        i = len(nodes["value"])
        for k, v in (("feature", 0), ("threshold", np.inf), ("left", i), ("right", i), ("value", 0.0)):
            nodes[k].append(v)
        return i

    if len(np.unique(y)) < 2:
        rounds = 0
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-margin))
        g, h = q - y, np.maximum(q * (1 - q), 1e-6)
        root = new_node()
        roots.append(root)
        live = [(root, np.arange(len(y)))]
        for level in range(depth + 1):
            grown = []
            for node, rows in live:
                gs, hs = g[rows].sum(), h[rows].sum()
                best = (1e-6, 0, 0)
                if level < depth and len(rows) >= 2 * least:
                    at = flat[rows].ravel()
                    bg = np.bincount(at, np.repeat(g[rows], f), f * width).reshape(f, width).cumsum(1)
                    bh = np.bincount(at, np.repeat(h[rows], f), f * width).reshape(f, width).cumsum(1)
                    bn = np.bincount(at, minlength=f * width).reshape(f, width).cumsum(1)
                    gain = bg**2 / (bh + smooth) + (gs - bg) ** 2 / (hs - bh + smooth) - gs**2 / (hs + smooth)
                    gain[(bn < least) | (len(rows) - bn < least)] = -1
                    k, b = divmod(int(np.argmax(gain)), width)
                    if gain[k, b] > best[0]:
                        best = (float(gain[k, b]), k, b)
                if best[0] > 1e-6 and best[2] < len(cuts[best[1]]):
                    _, k, b = best
                    low = code[rows, k] <= b
                    nodes["feature"][node], nodes["threshold"][node] = k, cuts[k][b]
                    nodes["left"][node], nodes["right"][node] = new_node(), new_node()
                    grown += [(nodes["left"][node], rows[low]), (nodes["right"][node], rows[~low])]
                else:
                    nodes["value"][node] = -rate * gs / (hs + smooth)
                    margin[rows] += nodes["value"][node]
            live = grown
    arrays = {k: np.array(v, float if k in ("threshold", "value") else np.int64) for k, v in nodes.items()}
    return Trees(base, np.array(roots, np.int64), depth=depth, **arrays)


def sampled(labels: DataFrame, id_col: str, most: int) -> DataFrame:
    """All rows of ``labels``, or about ``most`` of them picked by a hash of the id if there are more."""
    n = labels.count()
    if n <= most:
        return labels
    return labels.filter(F.pmod(F.xxhash64(id_col, F.lit(17)), F.lit(1 << 30)) < int((1 << 30) * most / n))


def text_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` but the text, and its statistics in the array ``stats``."""
    rest = [c for c in docs.columns if c != text_col]
    schema = T.StructType([*docs.select(*rest).schema.fields, T.StructField("stats", T.ArrayType(T.FloatType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = string_buffers(batch.column(len(rest)))
            for i, j in row_slices(offsets):
                x = statistics(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]).astype(np.float32)
                stats = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([*[batch.column(k).slice(i, j - i) for k in range(len(rest))], stats], [*rest, "stats"])

    return docs.select(*rest, text_col).mapInArrow(lean(run), schema)


def train(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Trees:
    """Fit the trees on at most about ``sample_rows`` labelled rows for which ``learn`` (on the id) holds."""
    known = labels.select(F.col(id_col), F.col(label_col).cast("int").alias("_y")).filter(F.col("_y").isin(0, 1) & learn)
    known = sampled(known, id_col, sample_rows)  # bounded, so that it can be broadcast
    rows = text_statistics(docs.select(id_col, text_col).join(F.broadcast(known), id_col).select("_y", text_col), text_col)
    got = rows.toPandas()
    x = np.array(got["stats"].tolist(), np.float32).astype(np.float64).reshape(len(got), len(FEATURES))
    order = np.lexsort(x.T)  # the same trees whatever order the rows came in
    return fit_trees(x[order], got["_y"].to_numpy(np.float64)[order])


def _scores(trees: Trees, column: pa.Array) -> np.ndarray:
    data, offsets = string_buffers(column)
    parts = []
    for i, j in row_slices(offsets):
        x = statistics(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        parts.append(trees.score(x.astype(np.float32).astype(np.float64)))
    return np.concatenate(parts) if parts else np.empty(0)


def score_quality(docs: DataFrame, trees: Trees, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Score every row: the id, score and predicted (1 if score >= ``threshold``, else 0).

    Null texts score as empty ones.  No other column is looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(trees)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = _scores(shared.value, batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64()), pa.array((score >= threshold).astype(np.int32))], ["id", "score", "predicted"])

    return docs.select(F.col(id_col).alias("id"), text_col).mapInArrow(lean(run), f"id {kind}, score double, predicted int").withColumnRenamed("id", id_col)


def quality_classifier(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """Fit on the labelled rows whose crc32(id) modulo 4 is not 2 and score all rows of ``docs``.

    Returns the id, held_out, score and predicted.  Labels that are null or neither
    0 nor 1 are passed over; without labels of both kinds every score is the same.
    Several labels of one document each count.  An empty table gives an empty
    result.
    """
    trees = train(docs, labels, crc_bucket(id_col, 4) != 2, id_col, text_col, label_col)
    return score_quality(docs, trees, id_col, text_col).select(id_col, (F.coalesce(crc_bucket(id_col, 4), F.lit(0)) == 2).alias("held_out"), "score", "predicted")


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` predicted to be of good quality, with all their columns; nothing is shuffled.

    Null texts score as empty ones, rows that repeat an id are each judged by their text,
    and a null id has no label.  An empty table stays empty; without labels of both kinds
    all rows stay or none.  Columns of any name go through.  The session's Arrow batches
    are small from then on.
    """
    small_batches(docs.sparkSession)
    trees = docs.sparkSession.sparkContext.broadcast(train(docs, labels, crc_bucket(id_col, 4) != 2, id_col, text_col))
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clear_worker_caches()
        for batch in batches:
            yield batch.filter(pa.array(_scores(trees.value, batch.column(at)) >= THRESHOLD))

    return docs.mapInArrow(lean(run), docs.schema)
