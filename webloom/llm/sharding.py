"""Sharding: balanced label propagation over links between documents.

Documents of equal text are linked.  Every document starts in the shard that a
hash of its id names.  Documents of one group that are in the same shard have
the same neighbours, so the graph is contracted to *fragments* (group, shard,
count); a group of any size has at most as many fragments as there are shards.
Each round, the fragments of a group ask to move to the shard that most of their
neighbours are in (a group larger than a shard to several).  How many rows may go
from shard to shard is a flow: what leaves a shard makes room for what enters, so
fragments are exchanged between full shards, in cycles of any length, and rows leave
shards that are over their quota first.  The strongest pull moves first; a
fragment that doesn't fit is split.  Rounds end when no fragment moves.  Groups that
are still cut are then put together whole, where there is room, where several
can be exchanged in a cycle or by packing them anew into the room they take, in lots of a fixed size.  Documents without links
can be anywhere at no cost; they fill up what the others leave, so that counts
are at most one apart.

The driver sees sums by shard, and the lots of groups that the rounds leave.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from webloom.llm.common import checkpointed, hash_bucket, with_rank, written


#: Rounds without a move after which label propagation ends; each breaks ties in another way.
IDLE_ROUNDS = 3
#: Groups left cut that the driver looks at together.
LOT = 5_000


def _pick(values: list[int], at: Column) -> Column:
    return F.element_at(F.array(*[F.lit(int(v)).cast("long") for v in values]), at + 1)


def _loads(fragments: DataFrame, shards: int) -> list[int]:
    sums = {r[0]: r[1] for r in fragments.groupBy("shard").agg(F.sum("n")).collect()}
    return [int(sums.get(s) or 0) for s in range(shards)]


def flows(asked: list[list[int]], load: list[int], quota: list[int]) -> list[list[int]]:
    """How many rows go from each shard to each, of those that ask to.

    No shard gets fuller than its quota, or than it was.  Paths from shards over
    their quota come first, then cycles and paths to shards with room; short ones first.
    """
    n = len(quota)
    left, load = [list(r) for r in asked], list(load)
    out = [[0] * n for _ in range(n)]

    def path(start: int, over: bool) -> list[int] | None:
        """The shortest path to a shard with room or, but from an overfull shard, back to ``start``."""
        queue, before = [start], {start: -1}
        for i in queue:
            for j in range(n):
                if left[i][j] <= 0:
                    continue
                if (j == start and not over) or (j not in before and load[j] < quota[j]):
                    steps = [j, i]
                    while before[steps[-1]] >= 0:
                        steps.append(before[steps[-1]])
                    return steps[::-1]
                if j not in before:
                    before[j] = i
                    queue.append(j)
        return None

    for over in (True, False):
        for start in range(n):
            while (not over or load[start] > quota[start]) and (steps := path(start, over)):
                most = min(left[i][j] for i, j in zip(steps, steps[1:], strict=False))
                if steps[0] != steps[-1]:
                    most = min(most, quota[steps[-1]] - load[steps[-1]])
                if over:
                    most = min(most, load[start] - quota[start])
                for i, j in zip(steps, steps[1:], strict=False):
                    left[i][j] -= most
                    out[i][j] += most
                load[steps[0]] -= most
                load[steps[-1]] += most
    return out


def propagate(fragments: DataFrame, quota: list[int], rounds: int | None) -> tuple[DataFrame, list[int]]:
    """Move the fragments (grp, shard, n) of linked groups; returns them and the loads of the shards.

    Every move is to a part of the group that is at least as large, so the sum of
    squares of the parts grows and the rounds end.
    """
    shards = len(quota)
    load = _loads(fragments, shards)
    of_group = Window.partitionBy("grp")
    idle, turn = 0, 0
    while idle < IDLE_ROUNDS and (rounds is None or turn < rounds):
        # of equal parts any can be the one to move to: a hash says which, another one each round
        ranked = of_group.orderBy(F.desc("n"), F.xxhash64("grp", "shard", F.lit(turn)), "shard")
        votes = (
            fragments.withColumn("place", F.row_number().over(ranked))
            .withColumn("wide", F.ceil(F.sum("n").over(of_group) / max(1, min(quota))).cast("int"))
            .withColumn("votes", F.array_sort(F.collect_list(F.struct("place", "shard", "n")).over(of_group)))
        )
        asked = checkpointed(
            votes.filter("place > wide")
            .withColumn("to", F.element_at("votes", 1 + F.pmod(F.col("place") - 1, F.col("wide"))))
            .select("grp", F.col("shard").alias("source"), F.col("to")["shard"].alias("to"), "n", F.col("to")["n"].alias("pull"))
            # strongest pull first: 64 classes of pull, 32 parts of each
            .withColumn("part", (63 - F.floor(F.log2("pull"))) * 32 + hash_bucket("grp", 32, turn))
        )
        wanted = [[0] * shards for _ in range(shards)]
        for r in asked.groupBy("source", "to").agg(F.sum("n")).collect():
            wanted[r[0]][r[1]] = int(r[2])
        turn += 1
        if not any(map(any, wanted)):
            break
        going = flows(wanted, load, quota)
        if not any(map(any, going)):
            idle += 1
            continue
        idle = 0
        sums = asked.groupBy("source", "to", "part").agg(F.sum("n").alias("s"))
        ahead = Window.partitionBy("source", "to").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.select("source", "to", "part", F.coalesce(F.sum("s").over(ahead), F.lit(0)).alias("ahead"))
        inside = Window.partitionBy("source", "to", "part").orderBy(F.desc("pull"), "grp").rowsBetween(Window.unboundedPreceding, -1)
        allowed = _pick([x for r in going for x in r], F.col("source") * shards + F.col("to"))
        moved = (
            asked.join(F.broadcast(sums), ["source", "to", "part"])  # at most shards * shards * 64 * 32 rows
            .withColumn("ahead", F.col("ahead") + F.coalesce(F.sum("n").over(inside), F.lit(0)))
            .withColumn("take", F.greatest(F.lit(0), F.least(F.col("n"), allowed - F.col("ahead"))))
            .filter("take > 0")
        )
        moves = moved.select("grp", F.col("to").alias("shard"), F.col("take").alias("n")).unionByName(
            moved.select("grp", F.col("source").alias("shard"), (-F.col("take")).alias("n"))
        )
        fragments = _after(fragments, moves)
        load = _loads(fragments, shards)
    idle = 0
    while idle < IDLE_ROUNDS and (rounds is None or turn < rounds):
        turn += 1
        size = F.sum("n").over(of_group)
        cut = fragments.withColumn("m", size).withColumn("parts", F.count(F.lit(1)).over(of_group)).filter((F.col("parts") > 1) & (F.col("m") <= max(quota)))
        lot = cut.groupBy("grp").agg(F.collect_list(F.struct("shard", "n")).alias("parts")).orderBy(F.xxhash64("grp", F.lit(turn))).limit(LOT).collect()
        moves = joined_groups({bytes(r["grp"]): {p["shard"]: p["n"] for p in r["parts"]} for r in lot}, load, quota)
        if not moves:
            if len(lot) < LOT:  # these were all
                break
            idle += 1
            continue
        idle = 0
        fragments = _after(fragments, fragments.sparkSession.createDataFrame([(bytearray(g), s, n) for g, s, n in moves], "grp binary, shard int, n long"))
        load = _loads(fragments, shards)
    return fragments, load


def _after(fragments: DataFrame, moves: DataFrame) -> DataFrame:
    return checkpointed(fragments.unionByName(moves).groupBy("grp", "shard").agg(F.sum("n").alias("n")).filter("n > 0"))


def joined_groups(groups: dict[bytes, dict[int, int]], load: list[int], quota: list[int]) -> list[tuple[bytes, int, int]]:
    """Changes (group, shard, rows) that put cut groups (rows by shard) together whole, without filling a shard over its quota.

    A group goes where there is room for the rest of it.  Groups of two equal parts that link
    shards in a cycle each move one part along it, which changes no load.  What is left is
    packed anew into the room that it takes.
    """
    groups, load = {g: dict(p) for g, p in sorted(groups.items())}, list(load)
    moves: list[tuple[bytes, int, int]] = []

    def gather(g: bytes, to: int) -> None:
        for s, n in groups.pop(g).items():
            if s != to:
                moves.extend([(g, s, -n), (g, to, n)])
                load[s] -= n
                load[to] += n

    changed = True
    while changed:
        changed = False
        for g in list(groups):
            m = sum(groups[g].values())
            fits = [s for s in range(len(quota)) if quota[s] - load[s] >= m - groups[g].get(s, 0)]
            if fits:
                gather(g, max(fits, key=lambda s: (groups[g].get(s, 0), load[s])))
                changed = True
        trees: dict[int, dict[int, dict[int, bytes]]] = {}  # by size of the parts: links between shards without a cycle
        for g in list(groups):
            parts = groups[g]
            if len(parts) != 2 or len(set(parts.values())) != 1:
                continue
            (a, b), tree = parts, trees.setdefault(next(iter(parts.values())), {})
            before = {a: a}
            queue = [a]
            for i in queue:
                for j in tree.get(i, {}):
                    if j not in before:
                        before[j] = i
                        queue.append(j)
            if b not in before:
                tree.setdefault(a, {})[b] = tree.setdefault(b, {})[a] = g
                continue
            at = b  # from b along the tree to a, and by g back to b
            while at != a:
                other = tree[at].pop(before[at])
                tree[before[at]].pop(at)
                gather(other, before[at])
                at = before[at]
            gather(g, b)
            changed = True
    return moves + _repacked(groups, load, quota)


def _repacked(groups: dict[bytes, dict[int, int]], load: list[int], quota: list[int]) -> list[tuple[bytes, int, int]]:
    """Changes that take cut groups out of all shards and put them back, large ones first, each where it fits best.

    Those that fit nowhere fill up what is left; there are no changes unless fewer are cut than before.
    """
    room = [q - x for q, x in zip(quota, load, strict=True)]
    for parts in groups.values():
        for s, n in parts.items():
            room[s] += n
    after: dict[bytes, dict[int, int]] = {}
    split: list[bytes] = []
    for g in sorted(groups, key=lambda g: (-sum(groups[g].values()), g)):
        m = sum(groups[g].values())
        fits = [s for s in range(len(room)) if room[s] >= m]
        if not fits:
            split.append(g)
            continue
        to = min(fits, key=lambda s: (room[s], -groups[g].get(s, 0)))
        room[to] -= m
        after[g] = {to: m}
    for g in split:
        m, after[g] = sum(groups[g].values()), {}
        for s in sorted(range(len(room)), key=lambda s: -room[s]):
            n = max(0, min(m, room[s]))
            if n:
                after[g][s] = n
                room[s] -= n
                m -= n
        if m:
            return []
    if len(split) >= len(groups):
        return []
    return [(g, s, after[g].get(s, 0) - parts.get(s, 0)) for g, parts in groups.items() for s in sorted({*parts, *after[g]}) if after[g].get(s, 0) != parts.get(s, 0)]


def shard_documents(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text", rounds: int | None = None, buckets: int = 1024) -> DataFrame:
    """Put every row into one of ``shards`` shards; the counts of any two differ by one at most.

    Returns one row for each row of ``docs``: the id, size (UTF-8 bytes of the
    text plus 1), text_crc32, law (``rows``), shard, slot (gapless from 0 in the
    shard) and grown_shard (null under this law).  A null text has no bytes.
    Repeated rows, and rows with a null id, are each placed.  With fewer rows than
    shards the last shards are empty; an empty table gives an empty result.  ``rounds``
    is a bound on the rounds; by default they end when nothing moves.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = written(
        docs.select(
            F.col(id_col).alias("id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("crc"),
            F.unhex(F.sha2(text.cast("binary"), 256)).alias("grp"),
            hash_bucket(id_col, shards).alias("start"),
            hash_bucket(id_col, buckets, 1).alias("b"),
        ),
        "shard-rows",
    )
    total = rows.count()
    quota = [total // shards + (s < total % shards) for s in range(shards)]
    linked = (
        rows.groupBy("grp", F.col("start").alias("shard"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("m", F.sum("n").over(Window.partitionBy("grp")))
        .filter("m > 1")
        .select("grp", "shard", "n")
    )
    fragments, load = propagate(checkpointed(linked), quota, rounds)
    # each group's stretches of ranks by shard, then the offset of each bucket in its group
    upto = Window.partitionBy("grp").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    stretches = (
        fragments.withColumn("upto", F.sum("n").over(upto))
        .groupBy("grp")
        .agg(F.array_sort(F.collect_list(F.struct("upto", "shard"))).alias("stretches"))
    )
    before = Window.partitionBy("grp").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        rows.groupBy("grp", "b")
        .agg(F.count(F.lit(1)).alias("n"))
        .join(stretches, "grp")
        .select("grp", "b", "stretches", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    )
    rank = F.col("before") + F.row_number().over(Window.partitionBy("grp", "b").orderBy("id")) - 1
    placed = written(
        rows.join(parts, ["grp", "b"], "left")
        .withColumn("rank", rank)
        .select("id", "size", "crc", "b", F.element_at(F.filter("stretches", lambda x: x["upto"] > F.col("rank")), 1)["shard"].alias("shard")),
        "placed",
    )
    if any(x > q for x, q in zip(load, quota, strict=True)):  # linked documents that found no room are placed with the others
        nth = with_rank(placed.filter("shard is not null"), ["shard"], "b", ["id", "crc"], "nth", small=True)
        kept = nth.withColumn("shard", F.when(F.col("nth") < _pick(quota, F.col("shard")), F.col("shard"))).drop("nth")
        placed = written(kept.select(*placed.columns).unionByName(placed.filter("shard is null")), "placed")
        load = [min(x, q) for x, q in zip(load, quota, strict=True)]
    # ballast: documents without links take the room that is left, by rank
    alone = with_rank(placed.filter("shard is null").drop("shard"), [], "b", ["id", "crc"], "rank", small=True)
    alone = alone.withColumn("shard", _first_above([quota[s] - load[s] for s in range(shards)], F.col("rank"))).drop("rank")
    full = written(placed.filter("shard is not null").select("id", "size", "crc", "b", "shard").unionByName(alone.select("id", "size", "crc", "b", "shard")), "full")
    slots = with_rank(full, ["shard"], "b", ["id", "crc"], "slot", small=True)
    return slots.select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def _first_above(room: list[int], rank: Column) -> Column:
    """The shard into whose room the rank falls when the rooms are laid end to end."""
    stop, out = 0, None
    for s, r in enumerate(room[:-1]):
        stop += r
        out = F.when(rank < stop, s) if out is None else out.when(rank < stop, s)
    return (F.lit(len(room) - 1) if out is None else out.otherwise(len(room) - 1)).cast("int")
