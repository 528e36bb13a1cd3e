"""N-gram Jaccard join: a blocked sparse product of the document by n-gram matrix.

Documents of equal shingle sets are one row of the matrix.  Each set is ordered
by one order of all shingles, frequent ones last, and cut after the prefix within
which two sets similar enough must meet.  The columns of these prefixes are dealt in
blocks by shingle hash; in a block, columns with a single entry drop out.  Two rows
are multiplied if they meet in a column where both still have enough entries to
come, which their sizes and places say.  Their product over the prefix columns is
the overlap there; what lies beyond is bounded by the sizes of the sets, and pairs
whose bound is too low are discarded.  The others are multiplied out in full.

Only components are asked for, so pairs inside one are not needed.  Columns are
first multiplied for neighbours of similar size alone, as many products as
entries, and the links found join most of a large group of near copies.  The
last products then take every pair of rows of different components, those of long
columns as blocks of rows by blocks of rows, so that no link between two is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from pyspark.sql.window import Window

from webloom.llm.bytewords import LOWER, NOT_BLANK, mix, run_hashes, span_hashes, word_spans
from webloom.llm.common import BROADCAST_IDS, arrow_rows, clear_worker_caches, hash_bucket, lacking, lean, names_rows, only_rows, row_slices, string_buffers, without_ids, written, written_counted
from webloom.llm.components import components

#: A shingle of more documents than this is frequent and goes last in the order.
FREQUENT = 16
#: Frequent shingles that are told apart, at most; the others keep their place in the order, which costs time only.
MOST_FREQUENT = 500_000
#: Prefix entries for one block of columns.
BLOCK_ENTRIES = 300_000
#: A column with more entries than this, of several components, is long and multiplied in blocks of rows.
LONG_COLUMN = 128
#: Rows of an Arrow batch, so that a batch of long texts stays small.
BATCH_ROWS = 1000
#: Rows of such a block, and shingles in them, about.
BLOCK_ROWS, BLOCK_ITEMS = 512, 500_000


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row in ascending order, and the offsets of the rows in them."""
    form = LOWER[data]
    starts, ends, first = word_spans(data, offsets, NOT_BLANK)
    h, n = run_hashes(span_hashes(form, starts, ends), first, size)
    at = np.concatenate([[0], np.cumsum(n)])
    for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        h[i:j].sort()
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    new[at[:-1][n > 0]] = True
    return h[new], np.concatenate([[0], np.cumsum(new)])[at]


def signatures(sets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A 64-bit number for each set, 0 for the empty one."""
    n = np.diff(at)
    out = np.zeros(len(n), np.uint64)
    held = np.flatnonzero(n)
    if len(held):
        out[held] = mix(np.add.reduceat(mix(sets ^ np.uint64(0x5851F42D4C957F2D)), at[:-1][held]) + n[held].astype(np.uint64))
    return out


def prefix_sizes(n: np.ndarray, percent: int) -> np.ndarray:
    """Shingles of a set of ``n`` within which it meets every set that it links with."""
    return np.where(n > 0, n + (-percent * n) // 100 + 1, 0)


def prefixes(sets: np.ndarray, at: np.ndarray, percent: int, frequent: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Which entries are in the prefix of their row, which of these are frequent, the place of each, and the last of each prefix in the order.

    The order: shingles that are not frequent by hash, then the frequent ones by
    count and hash.  The last is given as (count or 0, hash).
    """
    n = np.diff(at)
    p = prefix_sizes(n, percent)
    row = np.repeat(np.arange(len(n)), n)
    often = np.zeros(len(sets), bool)
    where = np.zeros(len(sets), np.int64)
    if len(frequent) and len(sets):
        where = np.searchsorted(frequent, sets).clip(max=len(frequent) - 1)
        often = frequent[where] == sets
    rank = np.concatenate([[0], np.cumsum(~often)])
    place = rank[:-1] - rank[at[row]]
    inside = ~often & (place < p[row])
    last_count, last_hash = np.zeros(len(n), np.int64), np.zeros(len(n), np.uint64)
    position = np.where(inside, np.arange(len(sets)), -1)
    held = np.flatnonzero(n)
    if len(held):
        end = np.maximum.reduceat(position, at[:-1][held])
        some = end >= 0
        last_hash[held[some]] = sets[end[some]]
    for r in np.flatnonzero(rank[at[1:]] - rank[at[:-1]] < p).tolist():
        own = np.arange(at[r], at[r + 1])[often[at[r] : at[r + 1]]]
        seldom = int(rank[at[r + 1]] - rank[at[r]])
        own = own[np.lexsort((sets[own], counts[where[own]]))][: p[r] - seldom]
        inside[own], place[own] = True, seldom + np.arange(len(own))
        last_count[r], last_hash[r] = counts[where[own[-1]]], sets[own[-1]]
    return inside, often & inside, place, last_count, last_hash


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


def set_rows(docs: DataFrame, size: int) -> DataFrame:
    """id, number of shingles and signature of each row of ``docs`` (id, text)."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clear_worker_caches()
        for batch in batches:
            data, offsets = string_buffers(batch.column(1))
            for i, j in row_slices(offsets):
                sets, at = shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], size)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(np.diff(at), pa.int64()), _signed(signatures(sets, at))], ["id", "n", "sig"])

    return docs.mapInArrow(lean(run), f"id {kind}, n long, sig long")


def _batch_prefixes(batch: pa.RecordBatch, size: int, percent: int, frequent: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Prefix entries of the distinct sets of a batch: hashes, signatures, frequent or not, places; and for each set its signature and last entry."""
    data, offsets = string_buffers(batch.column(0))
    known = np.empty(0, np.uint64)
    parts: list[tuple[np.ndarray, ...]] = []
    for i, j in row_slices(offsets):
        sets, at = shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], size)
        sig, n = signatures(sets, at), np.diff(at)
        fresh = np.zeros(len(sig), bool)
        fresh[np.unique(sig, return_index=True)[1]] = True
        fresh &= (n > 0) & ~np.isin(sig, known)
        known = np.concatenate([known, sig[fresh]])
        inside, often, place, last_count, last_hash = prefixes(sets, at, percent, frequent, counts)
        use = inside & np.repeat(fresh, n)
        parts.append((sets[use], np.repeat(sig, n)[use], often[use], place[use].astype(np.int32), sig[fresh], last_count[fresh], last_hash[fresh]))
    if not parts:
        none = np.empty(0, np.uint64)
        return none, none, np.empty(0, bool), np.empty(0, np.int32), none, np.empty(0, np.int64), none
    return tuple(np.concatenate([p[k] for p in parts]) for k in range(7))


def frequent_shingles(docs: DataFrame, size: int, percent: int, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of more than :data:`FREQUENT` prefixes, ascending, and how many they are in.

    Each batch sends a block of columns the counts of its own shingles, so a
    shingle that all documents share is one entry for each batch.
    """
    none, zero = np.empty(0, np.uint64), np.empty(0, np.int64)
    shift = np.uint64(64 - (blocks.bit_length() - 1))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clear_worker_caches()
        for batch in batches:
            h, n = np.unique(_batch_prefixes(batch, size, percent, none, zero)[0], return_counts=True)
            edge = np.searchsorted(h >> shift, np.arange(blocks + 1, dtype=np.uint64))
            rows = [(b, h[x:y].tobytes(), n[x:y].astype(np.uint16).tobytes()) for b, (x, y) in enumerate(zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)) if y > x]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())], ["block", "h", "n"])

    def total(table: pa.Table) -> pa.Table:
        h = np.concatenate([np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("h")])
        n = np.concatenate([np.frombuffer(x.as_buffer(), np.uint16) for x in table.column("n")]).astype(np.int64)
        order = np.argsort(h, kind="stable")
        h, n = h[order], n[order]
        at = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        sums = np.add.reduceat(n, at)
        held = sums > FREQUENT
        return pa.table({"h": _signed(h[at][held]), "n": pa.array(sums[held], pa.int64())})

    found = docs.select("text").mapInArrow(lean(count), "block int, h binary, n binary").groupBy("block").applyInArrow(total, "h long, n long")
    got = found.orderBy(F.desc("n"), "h").limit(MOST_FREQUENT).toArrow()
    h, n = np.asarray(got["h"].combine_chunks()).astype(np.int64).view(np.uint64), np.asarray(got["n"].combine_chunks()).astype(np.int64)
    order = np.argsort(h)
    return h[order], n[order]


def shared_columns(docs: DataFrame, size: int, percent: int, blocks: int, frequent: tuple[np.ndarray, np.ndarray]) -> tuple[DataFrame, DataFrame]:
    """Entries (h, sig, place) of prefix columns that have two entries or more, and the last prefix entry (sig, count, hash) of each set.

    Columns that are not frequent meet in blocks; the entries of frequent ones need no
    check and go through in as many parts as there are blocks.
    """
    shared = docs.sparkSession.sparkContext.broadcast(frequent)
    shift = np.uint64(64 - (blocks.bit_length() - 1))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clear_worker_caches()
        turn = 0
        for batch in batches:
            h, sig, often, place, own, last_count, last_hash = _batch_prefixes(batch, size, percent, *shared.value)
            order = np.flatnonzero(~often)
            order = order[np.argsort(h[order], kind="stable")]
            edge = np.searchsorted(h[order] >> shift, np.arange(blocks + 1, dtype=np.uint64))
            rows = [(b, h[order[x:y]].tobytes(), sig[order[x:y]].tobytes(), place[order[x:y]].tobytes()) for b, (x, y) in enumerate(zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)) if y > x]
            for k in range(0, int(often.sum()), 50_000):
                part = np.flatnonzero(often)[k : k + 50_000]
                turn += 1
                rows.append((blocks + (int(h[part[0]]) + turn) % blocks, h[part].tobytes(), sig[part].tobytes(), place[part].tobytes()))
            for k in range(0, len(own), 50_000):
                turn += 1
                rows.append((2 * blocks + (int(own[k]) + turn) % blocks, own[k : k + 50_000].tobytes(), last_hash[k : k + 50_000].tobytes(), last_count[k : k + 50_000].tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), *[pa.array([r[k] for r in rows], pa.binary()) for k in (1, 2, 3)]], ["block", "a", "b", "c"])

    def meet(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        a, b = (np.concatenate([np.frombuffer(x.as_buffer(), np.uint64) for x in table.column(k)]) for k in ("a", "b"))
        kind = np.int64 if block >= 2 * blocks else np.int32
        c = np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in table.column("c")]).astype(np.int64)
        if block < blocks:
            order = np.lexsort((b, a))
            a, b, c = a[order], b[order], c[order]
            new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
            a, b, c = a[new], b[new], c[new]
            same = a[1:] == a[:-1]
            held = np.concatenate([same, [False]]) | np.concatenate([[False], same])
            a, b, c = a[held], b[held], c[held]
        kind = np.full(len(a), 1 if block >= 2 * blocks else 0, np.int32)
        return pa.table({"kind": pa.array(kind), "a": _signed(a), "b": _signed(b), "c": pa.array(c, pa.int64())})

    met = docs.select("text").mapInArrow(lean(send), "block int, a binary, b binary, c binary").groupBy("block").applyInArrow(meet, "kind int, a long, b long, c long")
    met = written(met, "columns")
    entries = met.filter("kind = 0").select(F.col("a").alias("h"), F.col("b").alias("sig"), F.col("c").cast("int").alias("place")).distinct()
    # hashes count as unsigned in the order
    lasts = met.filter("kind = 1").groupBy(F.col("a").alias("sig")).agg(F.min("c").alias("last_count"), (F.min(F.col("b").bitwiseXOR(F.lit(-(2**63))))).alias("last_hash"))
    return entries, lasts


def enough(both: Column, n_a: Column, n_b: Column, percent: int) -> Column:
    """Whether an intersection of ``both`` makes sets of these sizes link."""
    return both * (100 + percent) >= (n_a + n_b) * percent


def full_rows(sigs: DataFrame, docs: DataFrame, classes: DataFrame, size: int) -> DataFrame:
    """The full set (sig, items) of each of ``sigs``, made anew from one document of the class and written once."""
    wanted, n = written_counted(sigs.distinct().join(classes.select("sig", F.col("low").alias("wanted")), "sig").select("wanted"), "wanted")
    known = F.broadcast(wanted) if n <= BROADCAST_IDS else wanted
    rows = docs.join(known, docs["id"].eqNullSafe(known["wanted"]), "left_semi").select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = string_buffers(batch.column(0))
            for i, j in row_slices(offsets):
                sets, at = shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], size)
                yield pa.RecordBatch.from_arrays([_signed(signatures(sets, at)), pa.ListArray.from_arrays(pa.array(at, pa.int32()), _signed(sets))], ["sig", "items"])

    sets, found = written_counted(rows.mapInArrow(lean(run), "sig long, items array<long>"), "sets")
    # only an id that is null or on several rows can bring a set in twice
    return sets if found <= n else written(sets.dropDuplicates(["sig"]), "sets")


def links_among(pairs: DataFrame, n_pairs: int, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the ``n_pairs`` ``pairs`` (a, b of signatures, each once) whose sets link: the full rows multiplied out.

    Two rows are multiplied at a time, so that pairs of very long sets take no more
    memory than these.
    """
    wanted = pairs.select(F.col("a").alias("sig")).union(pairs.select("b")).distinct()
    held = sets.join(F.broadcast(wanted) if 2 * n_pairs <= BROADCAST_IDS else wanted, "sig", "left_semi")
    one = pairs.join(held.select(F.col("sig").alias("a"), F.col("items").alias("x")), "a")
    both = one.join(held.select(F.col("sig").alias("b"), F.col("items").alias("y")), "b")
    return both.filter(enough(F.size(F.array_intersect("x", "y")), F.size("x"), F.size("y"), percent)).select("a", "b")


def block_product(left: list[np.ndarray], right: list[np.ndarray], width: int = 2048) -> np.ndarray:
    """Overlap counts of all rows of one block with all of another, summed up over stretches of columns."""
    rows = [*left, *right]
    row = np.repeat(np.arange(len(rows)), [len(x) for x in rows])
    _, column, times = np.unique(np.concatenate(rows), return_inverse=True, return_counts=True)
    use = times[column] > 1
    row, column = row[use], column[use]
    column = np.unique(column, return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(left), len(right)), np.float32)
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        x, y = np.searchsorted(column, [low, low + width])
        part = np.zeros((len(rows), width), np.float32)
        part[row[x:y], column[x:y] - low] = 1
        out += part[: len(left)] @ part[len(left) :].T
    return out


def _joining(linked: np.ndarray, left: list[int], right: list[int]) -> list[tuple[int, int]]:
    """A few of the linked pairs that join the same rows as all of them do."""
    top: dict[int, int] = {}

    def find(x: int) -> int:
        while top.setdefault(x, x) != x:
            top[x] = top[top[x]]
            x = top[x]
        return x

    out = []
    for i, j in zip(*(x.tolist() for x in np.nonzero(linked)), strict=True):
        a, b = find(left[i]), find(right[j])
        if a != b:
            top[a] = b
            out.append((left[i], right[j]))
    return out


def family_links(entries: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that join all rows of ``entries``, those of long columns, which link.

    Columns that occur in one row together are of one family; its rows are dealt to
    blocks by size and hash, and each two blocks of sizes that can link are
    multiplied as matrices in one task.  Two blocks that are already one component
    are passed over.  However large a family, no task holds more than two blocks.
    """
    least = entries.groupBy("sig").agg(F.min("h").alias("h0"), F.first("n").alias("n"), F.first("root").alias("root"))
    beside = entries.join(least.select("sig", "h0"), "sig").select(F.col("h0").alias("a"), F.col("h").alias("b")).distinct()
    families = components(beside).select(F.col("node").alias("h0"), F.col("root").alias("family"))
    base = float(np.log(100 / percent)) if percent < 100 else 1.0
    rows = least.join(families, "h0", "left").select("sig", "n", "root", F.coalesce("family", "h0").alias("family"), F.floor(F.log("n") / base).alias("level"))
    rows = written(rows, "family-rows")
    most = F.greatest(F.count(F.lit(1)) / BLOCK_ROWS, F.sum("n") / BLOCK_ITEMS)
    counts = rows.groupBy("family", "level").agg(F.ceil(most).cast("int").alias("parts"))
    full = rows.join(counts, ["family", "level"]).join(sets, "sig").withColumn("part", F.pmod(F.xxhash64("sig"), F.col("parts")))
    other = counts.select("family", F.col("level").alias("level2"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part2"))
    met = full.join(other, "family").filter(F.abs(F.col("level") - F.col("level2")) <= 1)
    own, its = F.struct("level", "part"), F.struct(F.col("level2").alias("level"), F.col("part2").alias("part"))
    dealt = met.select("sig", "root", "items", "family", F.least(own, its).alias("one"), F.greatest(own, its).alias("two"), (own <= its).alias("first"))

    def multiply(table: pa.Table) -> pa.Table:
        out: list[tuple[int, int]] = []
        if len(table.column("root").unique()) > 1:
            first, sig = table.column("first").to_pylist(), table.column("sig").to_pylist()
            items = [x.values.to_numpy(zero_copy_only=False).view(np.uint64) for x in table.column("items")]
            alone = table.column("one")[0] == table.column("two")[0]
            left = [i for i, f in enumerate(first) if f]
            right = left if alone else [i for i, f in enumerate(first) if not f]
            if left and right:
                n = np.array([len(x) for x in items], np.float64)
                both = block_product([items[i] for i in left], [items[i] for i in right])
                linked = both.astype(np.float64) * (100 + percent) >= (n[left][:, None] + n[right][None, :]) * percent
                out = _joining(linked, [sig[i] for i in left], [sig[i] for i in right])
        return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})

    return dealt.groupBy("family", "one", "two").applyInArrow(multiply, "a long, b long").filter("a <> b")


def may_begin(place: Column, n: Column, other: Column, percent: int) -> Column:
    """Whether a set of ``n`` that first meets another at ``place`` can still share enough with it."""
    return (n - place) * (100 + percent) >= (n + other) * percent


def neighbour_pairs(entries: DataFrame, turn: int, percent: int) -> DataFrame:
    """Pairs (a, b) of rows of different components that are neighbours by size in a column where they may begin to meet.

    A long column is cut in parts of about a thousand entries, other ones each turn.
    """
    parts = F.greatest(F.lit(1), F.floor(F.col("m") / 1000)).cast("int")
    spread = entries.withColumn("part", F.pmod(F.xxhash64("sig", F.lit(turn)), parts))
    order = Window.partitionBy("h", "part").orderBy("n", F.xxhash64("sig", F.lit(turn)))
    beside = spread.select("sig", "n", "place", "root", *[F.lag(c).over(order).alias(c + "2") for c in ("sig", "n", "place", "root")])
    beside = beside.filter((F.col("root") != F.col("root2")) & may_begin(F.col("place"), F.col("n"), F.col("n2"), percent) & may_begin(F.col("place2"), F.col("n2"), F.col("n"), percent))
    return beside.select(F.least("sig", "sig2").alias("a"), F.greatest("sig", "sig2").alias("b")).distinct()


def all_pairs(entries: DataFrame, percent: int) -> DataFrame:
    """All pairs (a, b) of rows of different components that meet in a column where they may begin to.

    Rows meet by column and class of size; sets that can link are of the same or
    of neighbouring classes.
    """
    base = float(np.log(100 / percent)) if percent < 100 else 1.0
    left = entries.select("h", "sig", "n", "place", "root").withColumn("level", F.floor(F.log("n") / base))
    right = left.select(*[F.col(c).alias(c + "2") for c in ("sig", "n", "place", "root")], "h", F.explode(F.sequence(F.col("level") - 1, F.col("level") + 1)).alias("level"))
    met = left.join(right, ["h", "level"]).filter(
        (F.col("sig") < F.col("sig2")) & (F.col("root") != F.col("root2")) & may_begin(F.col("place"), F.col("n"), F.col("n2"), percent) & may_begin(F.col("place2"), F.col("n2"), F.col("n"), percent)
    )
    return met.select(F.col("sig").alias("a"), F.col("sig2").alias("b")).distinct()


def within_bound(pairs: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` whose product over the prefix columns leaves the bound open.

    ``rows`` has the columns ``held`` of each sig, its size and its last prefix
    entry.  What two sets share beyond the prefix that ends first is at most what
    that set has left.
    """
    a = rows.select(F.col("sig").alias("a"), *[F.col(c).alias(c + "_a") for c in ("held", "n", "p", "last_count", "last_hash")])
    b = rows.select(F.col("sig").alias("b"), *[F.col(c).alias(c + "_b") for c in ("held", "n", "p", "last_count", "last_hash")])
    both = F.size(F.array_intersect("held_a", "held_b"))
    first = F.struct("last_count_a", "last_hash_a") <= F.struct("last_count_b", "last_hash_b")
    rest = F.when(first, F.col("n_a") - F.col("p_a")).otherwise(F.col("n_b") - F.col("p_b"))
    return pairs.join(a, "a").join(b, "b").filter(enough(both + rest, F.col("n_a"), F.col("n_b"), percent)).select("a", "b")


def ngram_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 75, turns: int = 2) -> DataFrame:
    """Components of the documents whose shingle sets have a Jaccard similarity of ``percent`` per cent or more.

    Returns one row for each row of ``docs``: the id, n_shingles and component_id
    (the smallest id reachable by links).  A text of fewer words than ``size`` is one
    shingle; null texts and texts without words have none, link with nothing and
    are their own component.  Rows that repeat an id or a text are each returned; ids
    that are null are passed over for component_id, which is null if a component
    has no other.  An empty table gives an empty result.
    """
    with arrow_rows(docs.sparkSession, BATCH_ROWS):  # all Python runs before this returns
        return _components(docs, id_col, text_col, size, percent, turns).select(id_col, "n_shingles", "component_id")


def _components(docs: DataFrame, id_col: str, text_col: str, size: int, percent: int, turns: int) -> DataFrame:
    """As :func:`ngram_components`, and the signature of each row's set and of its component's root."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = written(set_rows(docs, size).withColumn("salt", hash_bucket("id", 64)), "set-rows")
    # classes of equal sets, in two steps so that a class of any size is no task's burden
    parts = rows.filter("n > 0").groupBy("sig", "salt").agg(F.min("id").alias("low"), F.first("n").alias("n"))
    classes = written(parts.groupBy("sig").agg(F.min("low").alias("low"), F.first("n").alias("n")), "classes")
    p = (F.col("n") + F.floor(-F.col("n") * percent / 100) + 1).cast("long")
    total = classes.agg(F.sum(p)).first()[0] or 0
    blocks = 1 << max(6, int(total // BLOCK_ENTRIES).bit_length())
    frequent = frequent_shingles(docs, size, percent, blocks)
    _release(spark)
    entries, lasts = shared_columns(docs, size, percent, blocks, frequent)
    lengths = entries.groupBy("h").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    sizes = classes.select("sig", "n", p.alias("p"))
    entries = written(entries.join(lengths, "h").join(sizes.select("sig", "n"), "sig"), "entries")
    rows_of = entries.groupBy("sig").agg(F.collect_list("h").alias("held")).join(sizes, "sig").join(lasts, "sig")
    rows_of = written(rows_of, "prefix-rows")
    sets = full_rows(rows_of.select("sig"), docs, classes, size)
    _release(spark)
    links, roots, tested = None, None, None
    for turn in range(turns + 1):
        now = entries.join(roots, "sig", "left").withColumn("root", F.coalesce("root", "sig")) if roots is not None else entries.withColumn("root", F.col("sig"))
        if turn == turns:
            several = now.groupBy("h").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("k")).filter("lo <> hi")
            now = written(now.join(several.select("h", "k"), "h"), "open-entries")
            long, n_long = written_counted(now.filter(F.col("k") > LONG_COLUMN), "long-columns")
            if n_long:
                more = written(family_links(long, sets, percent), "family-links")
                links = more if links is None else links.unionByName(more)
        pairs = neighbour_pairs(now, turn, percent) if turn < turns else all_pairs(now.filter(F.col("k") <= LONG_COLUMN), percent)
        pairs = written(pairs.join(tested, ["a", "b"], "left_anti") if tested is not None else pairs, "pairs")
        tested = pairs if tested is None else tested.unionByName(pairs)
        open_, n_open = written_counted(within_bound(pairs, rows_of, percent), "open")
        if n_open:
            found = written(links_among(open_, n_open, sets, percent), "links")
            links = found if links is None else links.unionByName(found)
        if links is None:
            continue
        roots = written(components(links).select(F.col("node").alias("sig"), "root"), "roots")
        _release(spark)
    of_class = classes.select("sig", "low", F.col("sig").alias("root"))
    if roots is not None:
        joined = classes.join(roots, "sig", "left").select("sig", "low", F.coalesce("root", "sig").alias("root"))
        lowest = joined.groupBy("root").agg(F.min("low").alias("component"))
        of_class = joined.join(lowest, "root").select("sig", F.col("component").alias("low"), "root")
    near = parts.select("sig", "salt").join(of_class, "sig")
    return rows.join(near, ["sig", "salt"], "left").select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("low")).otherwise(F.col("id")).alias("component_id"), "sig", "root")


def _release(spark) -> None:
    """Let the cluster drop shuffle files that nothing refers to any more."""
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()


def with_signature(docs: DataFrame, text_col: str, n_name: str, sig_name: str, size: int = 5) -> DataFrame:
    """``docs`` with the number of shingles and the signature of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clear_worker_caches()
        for batch in batches:
            data, offsets = string_buffers(batch.column(batch.schema.get_field_index(text_col)))
            for i, j in row_slices(offsets):
                sets, at = shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], size)
                own = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(np.diff(at), pa.int64()), _signed(signatures(sets, at))], [*own.schema.names, n_name, sig_name])

    return docs.mapInArrow(lean(run), StructType([*docs.schema.fields, StructField(n_name, LongType()), StructField(sig_name, LongType())]))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component of ``docs``, that with the smallest id, with all its columns; rows without words all stay.

    Ids may be null or repeated: rows are then named by id and shingle set, and one row of
    each component stays, with an id if any has one.  An empty table stays empty, and
    columns of any name go through.
    """
    spark = docs.sparkSession
    with arrow_rows(spark, BATCH_ROWS):
        found = written(_components(docs, id_col, text_col, 5, 75, 2), "components")
        if names_rows(found, id_col):
            return without_ids(docs, found.filter(~F.col(id_col).eqNullSafe(F.col("component_id"))), id_col)
        # ids that are null or repeated: a row is named by its id and the signature of its set
        n, sig = lacking(docs.columns, "n"), lacking(docs.columns, "sig")
        low = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col("sig").alias("sig"))
        best = found.filter("n_shingles > 0").groupBy("root").agg(F.min(low).alias("low"))
        marked = written(with_signature(docs, text_col, n, sig), "signed")
    kept = only_rows(marked.filter(F.col(n) > 0), best.select(F.col("low.id").alias(id_col), F.col("low.sig").alias(sig)), [id_col, sig])
    return kept.unionByName(marked.filter(F.col(n) == 0)).drop(n, sig)


ORACLE = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[p : p + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS p FROM words WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), meets AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM shingles x JOIN shingles y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM meets JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id WHERE 100 * k >= 75 * (x.n + y.n - k)
), reach(doc, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT b, other FROM reach JOIN links ON a = doc
)
SELECT d.doc_id AS doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM documents d LEFT JOIN sizes ON d.doc_id = sizes.doc_id JOIN (SELECT doc, min(other) AS component_id FROM reach GROUP BY doc) ON doc = d.doc_id
"""
