"""Packing: documents into sequences of fixed length as a cutting-stock problem.

Every document is encoded and cut into full sequences and a remainder.  The
histogram of piece lengths, in classes that are exact for short pieces, is all that
reaches the driver.  There a linear program over patterns (how many pieces of each class
share a sequence) is solved by column generation: a dynamic program for the
knapsack prices new patterns against the duals until none lowers the number of
sequences.  Patterns are rounded down, the rest is packed best-fit, and the pieces
of each class, ranked across the cluster, take the places that the patterns hold
for that class.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from webloom.llm.common import arrow_rows, lean, row_slices, string_buffers, trim_memory, with_rank, written
from webloom.llm.tokens import END_ID, tokenizer_path, worker_tokenizer

#: Steps of the length classes: (up to this many tokens, width of a class).
CLASS_STEPS = ((256, 1), (512, 4), (1024, 8))
#: Width of the classes beyond.
CLASS_WIDTH = 16
#: Rows of an Arrow batch, so that a batch of long texts stays small.
BATCH_ROWS = 1000


def class_size(length: Column, limit: int) -> Column:
    """The size of a piece's class: its length rounded up, by less than two per cent."""

    def up(step: int) -> Column:
        return (F.ceil(length / step) * step).cast("long")

    size = F.when(length <= CLASS_STEPS[0][0], up(CLASS_STEPS[0][1]))
    for upto, step in CLASS_STEPS[1:]:
        size = size.when(length <= upto, up(step))
    return F.least(size.otherwise(up(CLASS_WIDTH)), F.lit(limit)).cast("int")


#: Patterns that one run of the dynamic program gives, at most.
PRICED = 64


def best_patterns(sizes: np.ndarray, worth: np.ndarray, capacity: int, most: int = PRICED) -> tuple[float, np.ndarray]:
    """The largest worth of pieces of the ascending ``sizes`` within ``capacity``, and patterns of it or near it.

    The dynamic program takes one size after the other.  With any number of pieces of
    size c, a room r is best filled from some r - k * c: a running maximum along the
    rooms that are r modulo c.  Patterns are the best one and, for the sizes that lose
    least by it, the best with a piece of that size.
    """
    best = np.zeros(capacity + 1)
    for c, w in zip(sizes.tolist(), worth.tolist(), strict=True):
        if w <= 1e-12:
            continue
        steps = -(-(capacity + 1) // c)
        table = np.full(steps * c, -np.inf)
        table[: capacity + 1] = best
        gain = np.arange(steps)[:, None] * w
        best = (np.maximum.accumulate(table.reshape(steps, c) - gain, axis=0) + gain).ravel()[: capacity + 1]
    best = np.maximum.accumulate(best)
    found = worth + best[capacity - sizes]
    patterns: dict[bytes, np.ndarray] = {}
    for first in np.argsort(-found, kind="stable")[:most].tolist():
        pattern, room = np.zeros(len(sizes), np.int64), capacity - int(sizes[first])
        pattern[first] = 1
        while room > 0 and best[room] > 1e-12:
            fit = int(np.searchsorted(sizes, room, "right"))
            rest = best[room - sizes[:fit]] + worth[:fit]
            k = int(np.argmax(rest)) if fit else 0
            if not fit or rest[k] < best[room] - 1e-9:
                break
            pattern[k] += 1
            room -= int(sizes[k])
        patterns[pattern.tobytes()] = pattern
    return float(best[capacity]), np.array(list(patterns.values()))


def largest_first(left: np.ndarray, sizes: np.ndarray, capacity: int) -> Iterator[tuple[np.ndarray, int]]:
    """Patterns and how often each is used to serve ``left`` pieces of each size, filled with the largest pieces first."""
    left = left.astype(np.int64).copy()
    while left.any():
        column, room = np.zeros(len(sizes), np.int64), capacity
        for i in range(len(sizes) - 1, -1, -1):
            column[i] = min(int(left[i]), room // int(sizes[i]))
            room -= int(column[i] * sizes[i])
        held = column > 0
        n = int((left[held] // column[held]).min())
        yield column, n
        left -= n * column


def _inverse(matrix: np.ndarray) -> np.ndarray:
    """The inverse by elimination with row pivots; the threads of LAPACK's own can hang in a process that has forked."""
    n = len(matrix)
    work = np.hstack([matrix.astype(np.float64), np.eye(n)])
    for k in range(n):
        p = k + int(np.argmax(np.abs(work[k:, k])))
        work[[k, p]] = work[[p, k]]
        work[k] /= work[k, k]
        factor = work[:, k].copy()
        factor[k] = 0
        held = np.flatnonzero(factor)
        work[held] -= factor[held, None] * work[k]
    return work[:, n:]


def cutting_stock(demand: np.ndarray, capacity: int, gap: float = 1e-3) -> tuple[list[tuple[np.ndarray, int]], float]:
    """Patterns and how often each is used, to serve ``demand[c - 1]`` pieces of each size c exactly, and a bound.

    Column generation on the revised simplex method.  Columns to choose from are first
    those of :func:`largest_first`; when none of them lowers the number of sequences, the
    knapsack gives new ones.  It stops when the bound on the optimum is within ``gap``,
    when 40 knapsacks have gained less than that, or when five in a row gain nothing.  The fractional rest is packed largest
    first.  The bound is the best found in any step: no packing of these sizes has
    fewer sequences.
    """
    classes = np.flatnonzero(demand) + 1
    if not len(classes):
        return [], 0.0
    need = demand[classes - 1].astype(np.float64)
    m = len(classes)
    columns = [np.eye(m)[i] * (capacity // c) for i, c in enumerate(classes)]
    inverse = np.diag([1.0 / (capacity // c) for c in classes])
    shaken = need + 1e-5 * np.random.default_rng(0).random(m)  # without ties no pivot is for nothing, and none comes back
    amount = inverse @ shaken
    pool = np.array([p for p, _ in largest_first(need, classes, capacity)], np.float64)
    bound = float(np.dot(need, classes)) / capacity
    before = at_pricing = least = np.inf  # numbers of sequences
    steps = last = priced = idle = 0
    while True:
        value = pool @ inverse.sum(axis=0)
        enter = int(np.argmax(value))
        total = float(amount.sum())
        if total < least * (1 - 1e-9):
            least, last = total, steps
        if value[enter] <= 1 + 1e-7 or steps - last > m:
            if priced % 40 == 39:
                if before - least < gap * before:
                    break
                before = least
            idle = idle + 1 if least > at_pricing * (1 - 1e-6) else 0
            if idle == 5:
                break
            at_pricing, last = least, steps
            priced += 1
            got, patterns = best_patterns(classes, inverse.sum(axis=0), capacity)
            bound = max(bound, float(inverse.sum(axis=0) @ need) / max(got, 1.0))
            if amount.sum() <= bound * (1 + gap):
                break
            pool = np.concatenate([pool[value > 0.9], patterns])  # those far from the duals go
            continue
        column = pool[enter]
        way = inverse @ column
        able = way > 1e-7
        ratio = np.full(m, np.inf)
        ratio[able] = np.maximum(amount[able], 0) / way[able]
        out = int(np.argmax(np.where(ratio <= ratio.min() * (1 + 1e-12), way, 0)))  # the largest pivot of the tied ones
        amount -= ratio[out] * way
        amount[out] = ratio[out]
        row = inverse[out] / way[out]
        inverse -= np.outer(way, row)
        inverse[out] = row
        columns[out] = column
        steps += 1
        if steps % 300 == 0:
            inverse = _inverse(np.array(columns).T)
            amount = inverse @ shaken
    amount = _inverse(np.array(columns).T) @ need
    left = demand[classes - 1].astype(np.int64).copy()
    plan: list[tuple[np.ndarray, int]] = []

    def use(column: np.ndarray, n: int) -> None:
        full = np.zeros(len(demand), np.int64)
        full[classes - 1] = column
        plan.append((full, n))

    for column, x in zip(columns, amount, strict=True):
        column = column.astype(np.int64)
        held = column > 0
        n = min(int(np.floor(x + 1e-6)), int((left[held] // column[held]).min()))
        if n > 0:
            use(column, n)
            left -= n * column
    for column, n in largest_first(left, classes, capacity):  # at most about one sequence for each class is left
        use(column, n)
    return plan, bound


def places(plan: list[tuple[np.ndarray, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """Which ranks of each class a pattern holds: (class, first rank, end rank, number a sequence, first sequence, first place)."""
    rows, begun, sequence = [], Counter(), 0
    for pattern, n in plan:
        place = 0
        for c in np.flatnonzero(pattern)[::-1]:
            k = int(pattern[c])
            rows.append((int(c) + 1, begun[c], begun[c] + n * k, k, sequence, place))
            begun[c] += n * k
            place += k
        sequence += n
    return rows


def token_pieces(docs: DataFrame, id_col: str, text_col: str, tokenizer: str, limit: int, keep_ids: bool = False) -> DataFrame:
    """Each document encoded, ended by id 2 and cut at multiples of ``limit``: one row for each piece."""
    path = tokenizer_path(tokenizer)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trim_memory()
        known = worker_tokenizer(path)
        for batch in batches:
            data, offsets = string_buffers(batch.column(1))
            for i, j in row_slices(offsets):
                ids, at = known.encode(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                ids = np.insert(ids, at[1:], END_ID).astype("<u4")
                total = np.diff(at) + 1
                n = -(-total // limit)
                row = np.repeat(np.arange(j - i), n)
                start = (np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)) * limit
                length = np.minimum(total[row] - start, limit)
                begin = (np.cumsum(total) - total)[row] + start
                raw = memoryview(ids.tobytes())
                crc = [zlib.crc32(raw[4 * b : 4 * (b + k)]) for b, k in zip(begin.tolist(), length.tolist(), strict=True)]
                columns = [batch.column(0).slice(i, j - i).take(pa.array(row)), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array(total[row], pa.int64())]
                names = ["id", "start", "length", "ids_crc32", "doc_tokens"]
                if keep_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate([begin, [len(ids)]]), pa.int32()), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * keep_ids
    return docs.select(F.col(id_col).alias("id"), text_col).mapInArrow(lean(run), schema)


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = "word_bpe_49k.json", limit: int = 4096, keep_ids: bool = False, buckets: int = 256) -> DataFrame:
    """Pack all rows of ``docs`` into sequences of at most ``limit`` tokens with little padding.

    Returns one row for each piece: the id, start, length, ids_crc32 (of the ids as
    little-endian 32-bit numbers), doc_tokens, sequence_id and offset in the
    sequence; with ``keep_ids`` also the ids.  Null and empty texts are the end id
    alone.  Rows that repeat an id are separate documents; a null id stays null.
    An empty table gives an empty result.
    """
    pieces = token_pieces(docs, id_col, text_col, tokenizer, limit, keep_ids)
    pieces = pieces.withColumn("cls", class_size(F.col("length"), limit)).withColumn("b", F.pmod(F.xxhash64("id", "start"), F.lit(buckets)).cast("int"))
    with arrow_rows(docs.sparkSession, BATCH_ROWS):
        pieces = written(pieces, "pieces")
    demand = np.zeros(limit, np.int64)
    for r in pieces.groupBy("cls").count().collect():  # a row for each class, a few hundred
        demand[r[0] - 1] = r[1]
    held = places(cutting_stock(demand, limit)[0])
    names = ("cls", "low", "high", "each", "first", "place")
    # an Arrow table goes to the JVM as it is, a list by Python workers of another kind, which would stay beside those at work
    table = pa.Table.from_arrays([pa.array([r[k] for r in held], pa.int64()) for k in range(len(names))], list(names))
    spans = docs.sparkSession.createDataFrame(table, T.StructType([T.StructField(x, T.LongType()) for x in names]))  # at most about two patterns for each class, with a row for each class they hold
    ranked = with_rank(pieces, ["cls"], "b", ["id", "start", "ids_crc32"], "rank", small=True).withColumn("cls", F.col("cls").cast("long"))
    at = F.col("rank") - F.col("low")
    placed = ranked.join(F.broadcast(spans), (ranked["cls"] == spans["cls"]) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))).select(
        "id", "start", "length", "ids_crc32", "doc_tokens", *["ids"] * keep_ids,
        (F.col("first") + F.floor(at / F.col("each"))).alias("sequence_id"),
        (F.col("place") + F.pmod(at, F.col("each"))).alias("place"),
    )
    ahead = Window.partitionBy("sequence_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select(
        F.col("id").alias(id_col), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", F.coalesce(F.sum("length").over(ahead), F.lit(0)).cast("long").alias("offset"), *["ids"] * keep_ids
    )
