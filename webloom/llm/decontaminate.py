"""Benchmark decontamination by Wu-Manber multi-pattern search.

The texts of the benchmark are cut into windows of ten consecutive words, each a
pattern of bytes: the words in lower case with one blank around each.  Document
text is brought to the same form and scanned.  A table indexed by a hash of an
8-byte block holds how far the scan may move on from a block that ends at the
present place; where the shift is zero, the patterns that have this very block at
the end of their common length are looked up by its hash, filtered by their first
bytes and compared byte by byte.  Thousands of stretches of a batch are scanned in
step with each other in numpy, each at its own pace.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.llm.common import WORKER_CACHES, clear_worker_caches, hash_bucket, lean, row_slices, small_batches, string_buffers, written

_TABLE_BITS = 20
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
#: Lower-case letters and digits stay, A to Z go to lower case, bytes of other characters stay, the rest are blanks.
_FORM = np.array([b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)], np.uint8)
#: Pattern bytes held by one set of tables; a larger benchmark is searched for in several sets.
SET_BYTES = 8 << 20


def words_of(text: str | None) -> list[bytes]:
    """Words of one text in the form in which they are compared."""
    return _FORM[np.frombuffer((text or "").encode(), np.uint8)].tobytes().split(b" ") if text else []


def windows_of(text: str | None, size: int) -> list[list[bytes]]:
    """The windows of one benchmark text."""
    words = [w for w in words_of(text) if w]
    return [words[i : i + size] for i in range(max(1, len(words) - size + 1))] if words else []


class WuManber:
    """Search for many byte strings at once."""

    def __init__(self, patterns: list[bytes], block: int = 8):
        self.patterns = patterns
        self.length = min(map(len, patterns))
        self.block = min(block, self.length)
        self.mask = np.uint64(2 ** (8 * self.block) - 1)
        heads = np.zeros((len(patterns), self.length + 8), np.uint8)
        for i, p in enumerate(patterns):
            heads[i, : self.length] = np.frombuffer(p[: self.length], np.uint8)
        furthest = self.length - self.block
        self.shift = np.full(1 << _TABLE_BITS, furthest + 1, np.int64)
        for at in range(furthest + 1):
            code = np.ascontiguousarray(heads[:, at : at + 8]).view("<u8")[:, 0]
            np.minimum.at(self.shift, self._slot(code), furthest - at)
        last = np.ascontiguousarray(heads[:, furthest : furthest + 8]).view("<u8")[:, 0] & self.mask
        self.order = np.argsort(last, kind="stable")
        self.last = last[self.order]
        first = np.zeros((len(patterns), 8), np.uint8)
        for i, p in enumerate(patterns):
            first[i, : min(8, len(p))] = np.frombuffer(p[:8], np.uint8)
        self.first = first.view("<u8")[:, 0]
        self.first_mask = np.array([2 ** (8 * min(8, len(p))) - 1 for p in patterns], np.uint64)

    def _slot(self, code: np.ndarray) -> np.ndarray:
        return (((code & self.mask) * _SPREAD) >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)

    def find(self, data: np.ndarray, stretch: int = 2048) -> tuple[np.ndarray, np.ndarray]:
        """Starts of all occurrences in ``data``, and which pattern occurs there."""
        if len(data) < self.length:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        codes = np.ndarray((len(data),), "<u8", padded, strides=(1,))  # the 8 bytes from each place on
        at = np.arange(self.length - self.block, len(data) - self.block + 1, stretch)  # starts of blocks
        stop = np.minimum(at + stretch, len(data) - self.block + 1)
        found = []
        while len(at):
            step = self.shift[self._slot(codes[at])]
            zero = step == 0
            if zero.any():
                found.append(at[zero])
            at = at + np.maximum(step, 1)
            go = at < stop
            at, stop = at[go], stop[go]
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        ends = np.concatenate(found)
        code = codes[ends] & self.mask
        low, high = np.searchsorted(self.last, code, "left"), np.searchsorted(self.last, code, "right")
        n = high - low
        starts = np.repeat(ends - (self.length - self.block), n)
        which = self.order[np.repeat(low - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
        close = (codes[starts] & self.first_mask[which]) == self.first[which]
        starts, which = starts[close], which[close]
        text = data.tobytes()
        same = np.fromiter((text.startswith(self.patterns[p], s) for s, p in zip(starts.tolist(), which.tolist(), strict=True)), bool, len(starts))
        return starts[same], which[same]


def pattern_sets(items: Iterable[tuple[str, str | None]], size: int) -> list[list[tuple[bytes, int, list[str]]]]:
    """Distinct windows as (pattern, number of words, item ids), in sets of bounded bytes and similar length."""
    owners: dict[bytes, dict[str, None]] = defaultdict(dict)
    for item, text in items:
        for w in windows_of(text, size):
            owners[b" " + b" ".join(w) + b" "][item] = None
    sets: dict[int, list] = defaultdict(list)
    out, used = [], defaultdict(int)
    for p in sorted(owners):
        n = p.count(b" ") - 1
        kind = 0 if n == size else len(p).bit_length()  # short windows would shorten every shift
        if used[kind] + len(p) > SET_BYTES:
            out.append(sets.pop(kind))
            used[kind] = 0
        sets[kind].append((p, n, list(owners[p])))
        used[kind] += len(p)
    return out + [s for _, s in sorted(sets.items())]


class Scanner:
    """Words of documents that are inside an occurrence of a window, and the items it is from."""

    def __init__(self, sets: list[list[tuple[bytes, int, list[str]]]]):
        self.sets = [(WuManber([p for p, _, _ in s]), np.array([n for _, n, _ in s]), [i for _, _, i in s]) for s in sets]

    def scan(self, data: np.ndarray, offsets: np.ndarray, before: list[list[int]] | None = None, want_spans: bool = False) -> tuple[np.ndarray, np.ndarray, list[list[str]], list[np.ndarray]]:
        """For each row: words, words hit, the sorted ids of items that occur and, if wanted, the stretches of words hit.

        Stretches are starts and ends by turns; those of ``before``, from a search for other
        windows, count as hit too.
        """
        rows = len(offsets) - 1
        # a blank before each row and a mark that no pattern has between rows
        form = np.insert(_FORM[data], np.repeat(offsets, 3), np.tile(np.array([0x20, 0x01, 0x20], np.uint8), rows + 1))
        blank = form == 0x20
        keep = ~blank
        keep[0] = True
        keep[1:] |= ~blank[:-1]
        form = form[keep]
        mark = np.flatnonzero(form == 0x01)  # rows + 1 of them
        starts_word = (form[1:] > 0x20) & (form[:-1] == 0x20)
        nth = np.concatenate([[0], np.cumsum(starts_word)])  # words that start at or before a place
        n_words = np.diff(nth[mark])
        change = np.zeros(int(nth[-1]) + 1, np.int64)
        items: list[set[str]] = [set() for _ in range(rows)]
        for search, n, ids in self.sets:
            at, which = search.find(form)
            first = nth[at]
            np.add.at(change, first, 1)
            np.add.at(change, first + n[which], -1)
            row = np.searchsorted(mark, at) - 1
            for r, p in set(zip(row.tolist(), which.tolist(), strict=True)):
                items[r].update(ids[p])
        begin = nth[mark]
        for r, known in enumerate(before or []):
            np.add.at(change, begin[r] + np.array(known[::2], np.int64), 1)
            np.add.at(change, begin[r] + np.array(known[1::2], np.int64), -1)
        inside = np.cumsum(change)[:-1] > 0
        hit = np.concatenate([[0], np.cumsum(inside)])
        edge = np.zeros(len(inside) + 1, bool)  # where a stretch starts or ends; none goes on into the next row
        edge[1:-1] = inside[1:] != inside[:-1]
        spans = []
        for i, j in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True) if want_spans else ():
            own = np.flatnonzero(edge[i + 1 : j]) + 1 if j > i else np.empty(0, np.int64)
            own = np.concatenate([np.zeros(int(j > i and inside[i]), np.int64), own])
            spans.append(np.concatenate([own, np.full(len(own) % 2, j - i)]))
        return n_words, np.diff(hit[begin]), [sorted(x) for x in items], spans


#: Bytes of benchmark text searched for in one pass over the documents; a larger benchmark takes several.
PASS_BYTES = 64 << 20

_SCANNERS: dict[str, Scanner] = {}
WORKER_CACHES.append(_SCANNERS.clear)


def scanner_of(key: str, sets) -> Scanner:
    """The scanner of a broadcast benchmark, made once in a worker process."""
    if key not in _SCANNERS:
        clear_worker_caches()  # what other operators have left in this worker, too
        _SCANNERS[key] = Scanner(sets.value)
    return _SCANNERS[key]


def _passes(benchmark: DataFrame, item_col: str, text_col: str, size: int, pass_bytes: int) -> Iterator[tuple[str, object, bool, bool]]:
    """The benchmark in parts of bounded size, each broadcast: a key, its sets of patterns, and whether it is the first or last part."""
    known = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text")).filter("item is not null")
    parts = max(1, -(-int(known.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // pass_bytes))
    for k in range(parts):
        rows = known.filter(hash_bucket("item", parts) == k).toLocalIterator()
        yield uuid.uuid4().hex, benchmark.sparkSession.sparkContext.broadcast(pattern_sets(((r[0], r[1]) for r in rows), size)), k == 0, k == parts - 1


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", size: int = 10, pass_bytes: int = PASS_BYTES
) -> DataFrame:
    """How much of each document is in windows of the benchmark.

    Returns one row for each row of ``docs``: the id, n_words, n_hit, n_items,
    items_sha256, contaminated and the array ``items`` (sorted as strings).  Null
    and empty texts have no words.  Items without words or id give no windows; an
    item of fewer words than ``size`` is one window.  Rows of one item id count as one
    item.  The benchmark is a set of queries that goes to the executors in parts of about
    ``pass_bytes`` of text; there is one pass over the documents for each, and all but
    the last write what they found, with the texts.  The document table is never shuffled.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    for key, sets, first, last in _passes(benchmark, item_col, item_text_col, size, pass_bytes):
        rows = _searched(rows if first else written(rows, "searched"), kind, key, sets, first, last)
    return rows.select(
        F.col("id").alias(id_col), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), "items",
    )


def _searched(rows: DataFrame, kind: str, key: str, sets, first: bool, last: bool) -> DataFrame:
    """``rows`` (id, text and, but for the first pass, spans and items) after one more pass: these columns or, of the last, the counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = scanner_of(key, sets)
        for batch in batches:
            data, offsets = string_buffers(batch.column(1))
            known, had = (None, None) if first else (batch.column(2).to_pylist(), batch.column(3).to_pylist())
            for i, j in row_slices(offsets):
                n, hit, items, spans = scanner.scan(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], known and known[i:j], not last)
                if had:
                    items = [sorted({*x, *y}) for x, y in zip(items, had[i:j], strict=True)]
                found = pa.array(items, pa.list_(pa.string()))
                if last:
                    columns, names = [found, pa.array(n, pa.int64()), pa.array(hit, pa.int64())], ["items", "n_words", "n_hit"]
                else:
                    columns, names = [batch.column(1).slice(i, j - i), pa.array([x.tolist() for x in spans], pa.list_(pa.int64())), found], ["text", "spans", "items"]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), *columns], ["id", *names])

    return rows.mapInArrow(lean(run), f"id {kind}, " + ("items array<string>, n_words long, n_hit long" if last else "text string, spans array<long>, items array<string>"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", size: int = 10, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """Rows of ``docs`` without a word in a window of the benchmark, with all their columns; nothing is shuffled.

    Rows of null and empty texts stay, and so do repeated ones; ids are not looked at.  An
    empty benchmark, or one without words, drops nothing.  The session's Arrow batches are
    small from then on.
    """
    at = docs.columns.index(text_col)
    small_batches(docs.sparkSession)

    def clean(rows: DataFrame, key: str, sets) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            scanner = scanner_of(key, sets)
            for batch in batches:
                data, offsets = string_buffers(batch.column(at))
                good = [scanner.scan(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])[1] == 0 for i, j in row_slices(offsets)]
                if good:
                    yield batch.filter(pa.array(np.concatenate(good)))

        return rows.mapInArrow(lean(run), rows.schema)

    for key, sets, first, _ in _passes(benchmark, item_col, item_text_col, size, pass_bytes):
        docs = clean(docs if first else written(docs, "searched"), key, sets)
    return docs


ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), win AS (
  SELECT DISTINCT item_id, k, array_to_string(w[p : p + k - 1], ' ') AS g
  FROM (SELECT item_id, w, least(len(w), 10) AS k, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) AS p FROM b WHERE len(w) > 0)
), grams AS (
  SELECT doc_id, k, p, array_to_string(w[p : p + k - 1], ' ') AS g
  FROM (SELECT doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS p FROM d, (SELECT DISTINCT k FROM win) WHERE len(w) >= k)
), occ AS (
  SELECT doc_id, item_id, p, grams.k AS k FROM grams JOIN win ON grams.g = win.g AND grams.k = win.k
), hit AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(generate_series(p, p + k - 1)) AS q FROM occ) GROUP BY doc_id
), its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS s FROM (SELECT DISTINCT doc_id, item_id FROM occ) GROUP BY doc_id
)
SELECT d.doc_id AS doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON d.doc_id = hit.doc_id LEFT JOIN its ON d.doc_id = its.doc_id
"""
