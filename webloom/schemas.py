"""Schemas of the tables and the settings of a run."""

from __future__ import annotations

import dataclasses
import datetime as dt
import os

from pyspark.sql import types as T

_KINDS = {"string": T.StringType(), "int": T.IntegerType(), "long": T.LongType(), "double": T.DoubleType(), "timestamp": T.TimestampType(), "array<string>": T.ArrayType(T.StringType())}


def _schema(fields: str) -> T.StructType:
    """A schema from ``name type, ...``, without a session."""
    return T.StructType([T.StructField(n, _KINDS[k]) for n, k in (x.split() for x in fields.split(", "))])


PAGE = _schema("url string, title string, content string, category string, links array<string>, timestamp string")
STATE = _schema("url string, hash string, category string, last_crawled timestamp")
EDGE = _schema("src string, dst string")
RANK = _schema("rank double, url string")
FINGERPRINT = _schema("url string, fp long")
INDEX = _schema("word string, urls array<string>")
FETCH_LOG = _schema("url string, attempt int, status int, error string, html string, at timestamp")

#: Keys that a page record must have.
REQUIRED_KEYS = ["url", "title", "content"]


@dataclasses.dataclass(frozen=True)
class Config:
    """What a run may vary.  ``as_of`` stands for the present in every comparison of times."""

    as_of: dt.datetime = dt.datetime(2024, 1, 1)
    root_domain: str = "example.com"
    fresh_days: int = 7
    page_cap: int = 5000
    high_rank: float = 5.0
    min_score: int = 2
    strict_host: bool = False
    touch_unchanged: bool = False
    force_recovered: bool = False

    @staticmethod
    def from_env(**given) -> Config:
        """Settings with ``MAX_PAGES`` from the environment; a cap of 0 or less is no cap."""
        return Config(**({"page_cap": int(os.environ.get("MAX_PAGES", "5000"))} | given))
