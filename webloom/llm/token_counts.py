"""Token counts: the exact histogram of encoded lengths and its suffix sums.

Documents are encoded where they are read and only their lengths go on.  They are
counted by length, so that however many documents there are, what is summed up
afterwards has a row for each distinct length, and for each context limit asked for.
Suffix sums over them then answer, for every length and limit, how many documents reach
it, how many tokens they hold and how many tokens are left if all are truncated to it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from webloom.llm.common import lean, row_slices, string_buffers, written
from webloom.llm.tokens import tokenizer_path, worker_tokenizer

#: Lengths by block of this size are summed on their own before the sums of blocks are.
BLOCK = 512


def document_lengths(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = "word_bpe_49k.json") -> DataFrame:
    """Id and number of tokens of each row; null and empty texts have none."""
    path = tokenizer_path(tokenizer)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = worker_tokenizer(path)
        for batch in batches:
            data, offsets = string_buffers(batch.column(1))
            for i, j in row_slices(offsets):
                n = known.counts(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(n, pa.int64())], ["id", "n_tokens"])

    return docs.select(F.col(id_col).alias("id"), text_col).mapInArrow(lean(run), f"id {kind}, n_tokens long").withColumnRenamed("id", id_col)


def suffix_sums(counted: DataFrame) -> DataFrame:
    """The answers of :func:`length_histogram` for a table of n_tokens and n_docs, one row for each length."""
    counted = counted.select("n_tokens", "n_docs", F.floor(F.col("n_tokens") / BLOCK).alias("block"))
    held = F.col("n_tokens") * F.col("n_docs")
    blocks = counted.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum(held).alias("t"))
    later = Window.partitionBy(F.lit(0)).orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(0))
    blocks = blocks.select(
        "block", F.coalesce(F.sum("d").over(later), F.lit(0)).alias("d"), F.coalesce(F.sum("t").over(later), F.lit(0)).alias("t"), F.sum("d").over(whole).alias("docs"), F.sum("t").over(whole).alias("tokens")
    )
    rest = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    suffix = counted.join(blocks, "block").withColumn("docs_from", F.col("d") + F.sum("n_docs").over(rest)).withColumn("tokens_from", F.col("t") + F.sum(held).over(rest))
    docs_upto = F.col("docs") - F.col("docs_from") + F.col("n_docs")
    tokens_upto = F.col("tokens") - F.col("tokens_from") + held
    return suffix.select(
        "n_tokens", "n_docs", docs_upto.alias("docs_upto"), "docs_from", tokens_upto.alias("tokens_upto"), "tokens_from",
        (F.col("tokens") - F.col("tokens_from") + F.col("n_tokens") * F.col("docs_from")).alias("truncated_tokens"),
        F.try_divide(docs_upto.cast("double"), F.col("docs").cast("double")).alias("quantile"),
    )


def with_limits(counted: DataFrame, limits: Iterable[int]) -> DataFrame:
    """``counted`` (n_tokens, n_docs) with a row of no documents for each context limit that no document has."""
    asked = counted.sparkSession.createDataFrame([(int(x), 0) for x in sorted(set(limits))], "n_tokens long, n_docs long")
    return counted.select("n_tokens", "n_docs").unionByName(asked).groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs"))


def length_histogram(docs: DataFrame, text_col: str = "text", tokenizer: str = "word_bpe_49k.json", limits: Iterable[int] = ()) -> DataFrame:
    """The histogram of encoded lengths with what it answers for each context limit.

    One row for each distinct length or one of ``limits``, L: n_tokens (L), n_docs (of
    that length, 0 for a limit that is none), docs_upto and docs_from (documents of at
    most, at least L tokens), tokens_upto, tokens_from, truncated_tokens (the total if
    each document keeps at most L tokens) and quantile (share of documents of at most L
    tokens).  Null and empty texts have length 0; an empty table gives rows for
    ``limits`` alone, of sums 0 and quantile null.
    """
    one = docs.select(F.lit(0).alias("_one"), text_col)
    lengths = document_lengths(one, "_one", text_col, tokenizer)
    counted = written(lengths.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs")), "lengths")
    return suffix_sums(with_limits(counted, limits))


def at_limits(histogram: DataFrame, limits: Iterable[int]) -> DataFrame:
    """What :func:`length_histogram` answers, for any context limits: one row for each distinct one.

    n_tokens (the limit), docs_from and tokens_from (documents of at least so many
    tokens), truncated_tokens (the total if each document keeps at most that many)
    and quantile (share of documents of at most that many).  For an empty histogram all
    but quantile, which is null, are 0.
    """
    asked = sorted({int(x) for x in limits})
    sums = suffix_sums(with_limits(histogram, asked))
    return sums.filter(F.col("n_tokens").isin(asked)).select("n_tokens", "docs_from", "tokens_from", "truncated_tokens", "quantile")


def at_quantiles(histogram: DataFrame, shares: Iterable[float]) -> DataFrame:
    """share and n_tokens, the least length that at least that share of documents don't exceed; null if there are none."""
    asked = sorted({float(q) for q in shares})
    held = histogram.agg(*[F.min(F.when((F.col("quantile") >= q) & (F.col("n_docs") > 0), F.col("n_tokens"))).alias(f"q{i}") for i, q in enumerate(asked)])
    return held.select(F.inline(F.array(*[F.struct(F.lit(q).alias("share"), F.col(f"q{i}").alias("n_tokens")) for i, q in enumerate(asked)])))
