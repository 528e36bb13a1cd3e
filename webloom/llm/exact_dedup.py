"""Exact dedup: a tree merge of sorted digest runs, in DataFrame operations alone.

Every row is dealt to one of many runs by a hash of its id, and a run is reduced to
one entry (digest, smallest id, count) per distinct text.  Then, round by round,
``fan_in`` neighbouring runs meet (eight are three binomial rounds in one exchange):
their entries are sorted by digest and id, and the head of each stretch of equal
digests, which holds the smallest id, takes the counts of the others.  After the
last round one entry per text is left.  The decision then travels the same tree
downwards, so a text that a third of all rows share meets at most ``fan_in`` entries
in any step and never lands in one task.  The number of runs grows with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from webloom.llm.common import hash_bucket, lacking, names_rows, only_rows, without_ids, written, written_counted

#: White space that counts as one blank.
SPACE_RUNS = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"

KEY = ["_digest", "_bytes", "_check"]


def normalised(text: Column) -> Column:
    """Text with each run of blanks, tabs and line ends replaced by one blank; null is empty.

    The pattern leaves single blanks alone, which are what they would become.
    """
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_RUNS, " ")


def digests(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One small row per document: id, SHA-256, byte length and a second hash of its text."""
    text = normalised(F.col(text_col))
    return docs.select(F.col(id_col).alias("_id"), text.alias("_t")).select(
        "_id",
        F.unhex(F.sha2(F.col("_t").cast("binary"), 256)).alias("_digest"),
        F.octet_length("_t").alias("_bytes"),
        F.xxhash64("_t").alias("_check"),
    )


def tree_merge(rows: DataFrame, fan_in: int, runs: int) -> list[DataFrame]:
    """The levels of the merge: entries by (text, run), each with fewer runs than the one before.

    Entries merge only where digest, length and the second hash all agree, so a
    clash of digests alone never joins two texts.
    """
    level = rows.groupBy(*KEY, "_run").agg(F.min("_id").alias("_low"), F.count(F.lit(1)).alias("_n"))
    levels = [level]
    stretch = Window.partitionBy("_run", *KEY)
    while runs > 1:
        runs = -(-runs // fan_in)
        met = level.withColumn("_run", F.floor(F.col("_run") / fan_in).cast("int"))
        place = F.row_number().over(stretch.orderBy(F.col("_low").asc_nulls_last()))
        level = met.select(*KEY, "_run", "_low", place.alias("_place"), F.sum("_n").over(stretch).alias("_n")).filter("_place = 1").drop("_place")
        levels.append(level)
    return levels


#: Rows of a run, about; beyond the least number of runs there are as many as that takes.
RUN_ROWS = 1_000_000


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", runs: int | None = None, fan_in: int = 8) -> DataFrame:
    """Group rows of equal text and say which one stays.

    Returns one row for each row of ``docs``: the id, keep_id (smallest id of the
    group), group_size, kept, text_sha256 (of the text with blanks normalised).
    Null texts equal empty ones.  An id that is null is larger than any other; if
    every id of a group is null, keep_id is null.  Where the row that stays is
    repeated with its id, one of the repeats is kept and the others are not.  An
    empty table gives an empty result; other columns are ignored.  ``runs`` is by
    default 64, or more so that a run has :data:`RUN_ROWS` rows at most, about.
    """
    rows, n = written_counted(digests(docs, id_col, text_col), "digests")
    runs = runs or max(64, -(-n // RUN_ROWS))
    rows = rows.withColumn("_run", hash_bucket("_id", runs))
    levels = tree_merge(rows, fan_in, runs)
    decided = levels[-1].select(*KEY, "_run", F.col("_low").alias("_keep"), F.col("_n").alias("_size"))
    for level in reversed(levels[:-1]):
        below = level.select(*KEY, F.col("_run").alias("_child"), F.floor(F.col("_run") / fan_in).cast("int").alias("_run"))
        decided = below.join(decided, [*KEY, "_run"]).select(*KEY, F.col("_child").alias("_run"), "_keep", "_size")
    same = Window.partitionBy(*KEY, "_run", "_id").orderBy("_id")
    return (
        rows.join(decided, [*KEY, "_run"])
        .withColumn("_nth", F.row_number().over(same))
        .select(
            F.col("_id").alias(id_col),
            F.col("_keep").alias("keep_id"),
            F.col("_size").alias("group_size"),
            (F.col("_id").eqNullSafe(F.col("_keep")) & (F.col("_nth") == 1)).alias("kept"),
            F.lower(F.hex("_digest")).alias("text_sha256"),
        )
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each text of ``docs``, the one that :func:`exact_dedup` keeps, with all its columns.

    Null texts and empty ones are one text.  Ids may be null or repeated: rows are then
    named by id and text.  Of rows that agree in both any one stays.  Columns of any
    name are left as they are; an empty table stays empty.
    """
    found = written(exact_dedup(docs, id_col, text_col), "copies")
    if names_rows(found, id_col):
        return without_ids(docs, found.filter(~F.col("kept")), id_col)
    mark = lacking(docs.columns, "digest")
    marked = docs.withColumn(mark, F.sha2(normalised(F.col(text_col)).cast("binary"), 256))
    return only_rows(marked, found.filter("kept").select(id_col, F.col("text_sha256").alias(mark)), [id_col, mark]).drop(mark)


ORACLE = r"""
SELECT doc_id,
       min(doc_id) OVER w AS keep_id,
       count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept,
       sha256(t) AS text_sha256
FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
WINDOW w AS (PARTITION BY t)
"""
