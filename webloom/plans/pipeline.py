"""The whole way from fetched pages to a knowledge base, stage by stage."""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.functions.html import parse_pages
from webloom.operators.ai import Scorer, overridden, reorganise
from webloom.operators.classify import CATEGORIES, Taxonomy, classify
from webloom.operators.graph import link_edges, node_set, pagerank
from webloom.operators.index import inverted_index
from webloom.operators.neardup import fingerprints, near_pairs
from webloom.operators.render import markdown, with_rank
from webloom.operators.state import change_status, state_rows, upsert, with_hash
from webloom.plans.storage import saved
from webloom.schemas import Config


@dataclasses.dataclass
class KnowledgeBase:
    pages: DataFrame
    state: DataFrame
    ranks: DataFrame
    pairs: DataFrame
    index: DataFrame
    files: DataFrame


def run(fetched: DataFrame, state: DataFrame, config: Config, rules: Taxonomy = CATEGORIES, scorer: Scorer | None = None) -> KnowledgeBase:
    """Parse fetched pages (url, html), find what changed, classify, rank, compare, index and render them.

    Nothing goes through files between stages but the parsed pages, which several
    stages read.  With a scorer, uncategorised pages are judged by it before they are
    rendered, so that its category holds everywhere.
    """
    parsed = classify(parse_pages(fetched, config.root_domain), F.col("url"), F.concat_ws(" ", "title", "content"), rules, over=config.min_score)
    parsed = saved(parsed, "parsed")
    if scorer is not None:
        leftovers = parsed.filter("category = 'uncategorized'").select("url", F.concat_ws("\n", "title", "content").alias("md"))
        parsed = saved(overridden(parsed, reorganise(leftovers, scorer)), "judged")
    changed = change_status(with_hash(parsed, F.col("content")), state)
    new_state = upsert(state, state_rows(changed, config.as_of, config.touch_unchanged), "url")
    edges = link_edges(parsed)
    ranks = pagerank(node_set(parsed, edges), edges)
    ranked = with_rank(parsed, ranks, config.high_rank)
    prints = fingerprints(parsed.filter("content <> ''"), "url", F.col("content"))
    return KnowledgeBase(parsed, new_state, ranks, near_pairs(prints, "url"), inverted_index(parsed, "url", F.col("content")), markdown(ranked))
