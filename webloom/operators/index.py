"""Inverted index over cleaned words."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.functions.text import clean_word, tokens


def postings(df: DataFrame, key: str, text: Column, longer_than: int = 3) -> DataFrame:
    """Distinct (word, key) for words of more than ``longer_than`` letters and digits."""
    words = F.array_distinct(F.filter(F.transform(tokens(text), clean_word), lambda w: F.length(w) > longer_than))
    return df.select(F.col(key), F.explode(words).alias("word")).distinct()


def inverted_index(df: DataFrame, key: str, text: Column, longer_than: int = 3) -> DataFrame:
    """word and the sorted array of keys that hold it."""
    return postings(df, key, text, longer_than).groupBy("word").agg(F.sort_array(F.collect_list(key)).alias("keys"))


def document_frequencies(df: DataFrame, key: str, text: Column, longer_than: int = 3) -> DataFrame:
    """word and the number of keys that hold it, without lists that grow with the corpus."""
    return postings(df, key, text, longer_than).groupBy("word").agg(F.count(F.lit(1)).alias("n_docs"))


def lookup(index: DataFrame, word: str) -> DataFrame:
    """Keys of one word of an index or of postings, one row each."""
    found = index.filter(F.col("word") == word.lower())
    return found.select(F.explode("keys").alias("key")) if "keys" in index.columns else found.select(F.col([c for c in index.columns if c != "word"][0]).alias("key"))


def lookup_all(index: DataFrame, words: list[str], how: str = "and") -> DataFrame:
    """Keys that hold all (``and``) or any (``or``) of the words, of an index or of postings.

    Postings are read once and only the words asked for go on, with no list of a word's keys in one row.
    """
    if "keys" in index.columns:
        found = [lookup(index, w) for w in words]
        return reduce(lambda a, b: a.intersect(b), found) if how == "and" else reduce(lambda a, b: a.union(b), found).distinct()
    asked = sorted({w.lower() for w in words})
    key = next(c for c in index.columns if c != "word")
    held = index.filter(F.col("word").isin(asked)).groupBy(F.col(key).alias("key")).agg(F.count_distinct("word").alias("n"))
    return held.filter(F.col("n") >= (len(asked) if how == "and" else 1)).select("key")


def index_lines(index: DataFrame) -> DataFrame:
    """Lines ``word TAB key key ...``."""
    return index.select(F.concat("word", F.lit("\t"), F.concat_ws(" ", F.col("keys").cast("array<string>"))).alias("value"))
