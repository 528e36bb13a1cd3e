"""Pages as Markdown with front matter, priorities, and training lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.functions.text import safe_filename


def with_rank(pages: DataFrame, ranks: DataFrame, high: float = 5.0) -> DataFrame:
    """Pages with ``pagerank`` (six decimals, 1 if unknown) and ``priority``."""
    known = ranks.select(F.col("id").alias("url"), F.col("rank").alias("_rank"))
    rank = F.round(F.coalesce("_rank", F.lit(1.0)), 6)
    return pages.join(known, "url", "left").withColumn("pagerank", rank).withColumn("priority", F.when(rank > high, "high").otherwise("normal")).drop("_rank")


def unescaped(text: Column) -> Column:
    r"""``\n``, ``\t`` and ``\"`` of still escaped text replaced, nothing else."""
    return F.replace(F.replace(F.replace(text, F.lit("\\n"), F.lit("\n")), F.lit("\\t"), F.lit("\t")), F.lit('\\"'), F.lit('"'))


def markdown(pages: DataFrame) -> DataFrame:
    """category, filename and md of pages (url, title, category, content, pagerank, priority)."""
    category = F.coalesce(F.nullif("category", F.lit("")), F.lit("uncategorized"))
    md = F.concat_ws(
        "\n",
        F.lit("---"),
        F.concat(F.lit("url: "), "url"),
        F.concat(F.lit("title: "), F.coalesce("title", F.lit(""))),
        F.concat(F.lit("category: "), category),
        F.format_string("pagerank_score: %.6f", "pagerank"),
        F.concat(F.lit("priority: "), "priority"),
        F.lit("---"),
        F.lit(""),
        F.concat(F.lit("# "), F.coalesce("title", F.lit(""))),
        F.lit(""),
        F.coalesce("content", F.lit("")),
    )
    return pages.filter(F.col("url") != "").select(category.alias("category"), safe_filename(F.col("url")).alias("filename"), md.alias("md"))


def collisions(rendered: DataFrame) -> DataFrame:
    """File names that more than one page has."""
    return rendered.groupBy("category", "filename").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def url_of_markdown(md: Column) -> Column:
    """The URL in the front matter; empty if there is none."""
    return F.trim(F.regexp_extract(md, r"(?m)^url: (.*)$", 1))


def training_text(title: Column, content: Column) -> Column:
    return F.concat(F.lit("Title: "), F.coalesce(title, F.lit("")), F.lit("\nContent: "), F.coalesce(content, F.lit("")))


def training_lines(pages: DataFrame) -> DataFrame:
    """JSON lines {url, text, meta{title, category, timestamp}}."""
    meta = F.struct("title", "category", "timestamp")
    return pages.select(F.to_json(F.struct("url", training_text(F.col("title"), F.col("content")).alias("text"), meta.alias("meta"))).alias("value"))
