"""Near-duplicates by SimHash: fingerprints, and pairs within a few bits."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.functions.text import LOW32, fnv1a, hamming, simhash, tokens
from webloom.plans.storage import saved


def fingerprints(df: DataFrame, key: str, text: Column) -> DataFrame:
    """key and fp of every row, by the vectorised function."""
    return df.select(key, simhash(text).alias("fp"))


#: Words that are hashed once and broadcast; others are hashed where they stand.
COMMON_WORDS, COMMON_BYTES = 65_536, 64


def fingerprints_sql(df: DataFrame, key: str, text: Column) -> DataFrame:
    """The same in built-in functions: frequent words are hashed once, the others in place; bits are summed by document.

    No word is sent anywhere but to be counted, so a document is summed up where it
    was read and what is shuffled is its sums.  A sum holds two bits, 32 places apart.
    """
    words = df.select(key, F.explode(tokens(text)).alias("w"))
    common = words.filter(F.octet_length("w") <= COMMON_BYTES).groupBy("w").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").orderBy(F.desc("n")).limit(COMMON_WORDS)
    hashed = words.join(F.broadcast(common.select("w", fnv1a(F.col("w")).alias("h"))), "w", "left").select(key, F.coalesce("h", fnv1a(F.col("w"))).alias("h"))
    two = F.lit((1 << 32) + 1).cast("long")
    bits = [F.sum(F.shiftrightunsigned("h", i).bitwiseAND(two)).alias(f"b{i}") for i in range(32)]
    sums = hashed.groupBy(key).agg(F.count(F.lit(1)).alias("n"), *bits)
    ones = [F.col(f"b{i}").bitwiseAND(F.lit(LOW32)) for i in range(32)] + [F.shiftrightunsigned(f"b{i}", 32) for i in range(32)]
    fp = reduce(lambda a, b: a.bitwiseOR(b), [F.when(2 * one > F.col("n"), F.shiftleft(F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")) for i, one in enumerate(ones)])
    return df.select(key).join(sums.select(key, fp.alias("fp")), key, "left").select(key, F.coalesce("fp", F.lit(0).cast("long")).alias("fp"))


#: Keys of equal fingerprints are listed in lots of about this many; no row holds more than a lot and a half or so.
LOT_KEYS = 256


def near_pairs(fps: DataFrame, key: str, most: int = 3) -> DataFrame:
    """Pairs (a, b, dist) of keys whose fingerprints differ in at most ``most`` (up to 3) bits, a < b.

    Equal fingerprints are one point first, so that many copies of a text are
    compared once.  A point's keys are dealt into lots, and pairs of lots are spread over
    the tasks before they are expanded, so that a class that many share is no single task's.
    Fingerprints are computed once and written to the shared folder.
    """
    fps = saved(fps.select(F.col(key).alias("key"), "fp").filter("key is not null"), "fingerprints")
    points = fps.groupBy("fp").agg(F.count(F.lit(1)).alias("n")).withColumn("m", F.ceil(F.col("n") / LOT_KEYS).cast("int"))
    large = points.filter("m > 1").select("fp", "m")
    lot = F.pmod(F.xxhash64("key"), F.coalesce("m", F.lit(1))).cast("int")
    lots = fps.join(F.broadcast(large), "fp", "left").groupBy("fp", lot.alias("c")).agg(F.collect_list("key").alias("keys"))
    links = _close(points.select("fp", "m"), most).unionByName(points.filter("n > 1").select("fp", F.col("fp").alias("fp2"), "m", F.col("m").alias("m2"), F.lit(0).alias("dist")))
    dealt = (
        links.withColumn("c", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
        .withColumn("c2", F.explode(F.sequence(F.lit(0), F.col("m2") - 1)))
        .filter("fp <> fp2 or c <= c2")
        .select("fp", "c", "fp2", "c2", "dist")
    )
    pairs = (
        dealt.join(lots.hint("merge"), ["fp", "c"])
        .join(lots.select(F.col("fp").alias("fp2"), F.col("c").alias("c2"), F.col("keys").alias("keys2")).hint("merge"), ["fp2", "c2"])
        .select(F.expr("fp = fp2 and c = c2").alias("own"), F.explode("keys").alias("p"), "keys2", "dist")
        .select("own", "p", F.explode("keys2").alias("q"), "dist")
        .filter("p < q or (p > q and not own)")
    )
    return pairs.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b"), "dist")


def near_links(fps: DataFrame, most: int = 3) -> DataFrame:
    """Pairs (fp, fp2, dist) of distinct fingerprints that differ in at most ``most`` (up to 3) bits, fp < fp2.

    With :func:`near_classes` for who has which fingerprint, this says the same as
    :func:`near_pairs` without expanding classes into pairs of keys.
    """
    return _close(fps.select("fp", F.lit(1).alias("m")).distinct(), most).select("fp", "fp2", "dist")


#: Bits of the seven blocks of a fingerprint, lowest first.
_WIDTHS = (10, 9, 9, 9, 9, 9, 9)
_BLOCKS = [((1 << w) - 1) << sum(_WIDTHS[:i]) for i, w in enumerate(_WIDTHS)]


def _close(points: DataFrame, most: int) -> DataFrame:
    """Pairs of points (fp, m) with fp < fp2 that differ in at most ``most`` (up to 3) bits.

    Three bits lie in at most three of seven blocks, so that four agree; those 37 bits are
    the key of a join.  A pair is taken in its lowest four blocks that agree alone.
    """
    if most > 3:
        raise ValueError("fingerprints are compared up to 3 bits")

    def mask(bits: int) -> Column:
        whole = sum(b for i, b in enumerate(_BLOCKS) if bits >> i & 1)
        return F.lit(whole - (1 << 64) if whole >> 63 else whole).cast("long")

    fours = [sum(1 << i for i in c) for c in combinations(range(7), 4)]
    blocks = points.select("fp", "m", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col("fp").bitwiseAND(mask(k)).alias("v")) for k in fours])).alias("b"))
    x = blocks.select("fp", "m", "b.k", "b.v")
    y = blocks.select(F.col("fp").alias("fp2"), F.col("m").alias("m2"), "b.k", "b.v")
    diff, k = F.col("fp").bitwiseXOR(F.col("fp2")), F.col("k")
    agree = reduce(lambda a, b: a.bitwiseOR(b), [F.when(diff.bitwiseAND(mask(1 << i)) == 0, 1 << i).otherwise(0) for i in range(7)])
    upto = reduce(lambda a, n: a.bitwiseOR(F.shiftright(a, n)), [1, 2, 4], k)
    close = x.join(y.hint("merge"), ["k", "v"]).filter((F.col("fp") < F.col("fp2")) & (hamming(F.col("fp"), F.col("fp2")) <= most) & (agree.bitwiseAND(upto) == k))
    return close.select("fp", "fp2", "m", "m2", hamming(F.col("fp"), F.col("fp2")).cast("int").alias("dist"))


def near_classes(fps: DataFrame, key: str, parts: int = 64) -> DataFrame:
    """key, fp, the smallest key of equal fingerprints and how many there are, without listing their pairs.

    Classes are summed up in parts, and the sums go back to the parts, so that one that
    holds a third of all rows is no single task's.  Fingerprints are computed once and
    written to the shared folder.
    """
    part = F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")
    rows = saved(fps.select(key, "fp"), "fingerprints").withColumn("_part", part)
    sums = rows.groupBy("fp", "_part").agg(F.min(key).alias("_low"), F.count(F.lit(1)).alias("_n"))
    whole = sums.groupBy("fp").agg(F.min("_low").alias("first_key"), F.sum("_n").alias("n"))
    return rows.join(sums.select("fp", "_part").join(whole, "fp"), ["fp", "_part"]).select(key, "fp", "first_key", "n")
