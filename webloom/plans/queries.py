"""The registered queries over the driver's tables, each with its DuckDB SQL where SQL can say it.

The tables stand in for crawl data: ``documents`` and ``pages`` for page records,
``labels`` for rechecks and stored states, ``events`` for a fetch log (user_id for
the host, event_type for the outcome).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from webloom.functions import html, text, url
from webloom.operators import ai, classify, fetchlog, frontier, graph, index, neardup, render, state, validate

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
ROOT = "example.com"
AS_OF = "2024-01-20 00:00:00"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def keep(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return keep


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------- words and index
_WORDS = r"""SELECT DISTINCT doc_id, word FROM (
  SELECT doc_id, lower(regexp_replace(w, '[^A-Za-z0-9]', '', 'g')) AS word
  FROM (SELECT doc_id, unnest(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0B\f\r]+')) AS w FROM documents)) WHERE length(word) > 3"""


@query(f"SELECT word, list(doc_id ORDER BY doc_id) AS keys FROM ({_WORDS}) GROUP BY word")
def inverted_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.inverted_index(_t(spark, sf_dir, "documents"), "doc_id", F.col("text"))


@query(f"SELECT word, count(*) AS n_docs FROM ({_WORDS}) GROUP BY word")
def document_frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.document_frequencies(_t(spark, sf_dir, "documents"), "doc_id", F.col("text"))


@query(f"SELECT doc_id AS key FROM ({_WORDS}) WHERE word = 'with'")
def index_term_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.postings(_t(spark, sf_dir, "documents"), "doc_id", F.col("text")).filter("word = 'with'").select(F.col("doc_id").alias("key"))


@query(f"SELECT doc_id AS key FROM ({_WORDS}) WHERE word = 'with' INTERSECT SELECT doc_id FROM ({_WORDS}) WHERE word = 'that'")
def index_lookup_and(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.lookup_all(index.postings(_t(spark, sf_dir, "documents"), "doc_id", F.col("text")), ["with", "that"])


@query(f"SELECT DISTINCT doc_id AS key FROM ({_WORDS}) WHERE word IN ('idiot', 'license')")
def index_lookup_or(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.lookup_all(index.postings(_t(spark, sf_dir, "documents"), "doc_id", F.col("text")), ["idiot", "license"], "or")


@query(f"SELECT count(DISTINCT word) AS n_words FROM ({_WORDS})")
def index_unique_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_frequencies(spark, sf_dir).agg(F.count(F.lit(1)).alias("n_words"))


# ---------------------------------------------------------------- classification
_SMALL = {
    "english": ["the", "and", "that"],
    "german": ["der", "und", "ung"],
    "french": ["eau", "ment", "oi"],
    "spanish": ["ción", "que", "ado"],
    "legal": ["licensed under"],
}


def _classified_sql(rules: classify.Taxonomy, table: str, key: str, u: str, body: str, over: int, default: str, cap: int | None) -> str:
    rows = ", ".join(f"({i}, '{n}', '{w}')" for i, (n, ws) in enumerate(rules.items()) for w in ws)
    count = "((length(t) - length(replace(t, kw, ''))) // length(kw))"
    count = f"least({count}, {cap})" if cap else count
    return f"""WITH tax(ord, category, kw) AS (VALUES {rows}),
      src AS (SELECT {key}, lower(coalesce({u}, '')) AS u, lower(coalesce({body}, '')) AS t FROM {table}),
      sums AS (SELECT {key}, ord, category, sum({count} + CASE WHEN contains(u, kw) THEN 5 ELSE 0 END) AS s FROM src, tax GROUP BY ALL),
      best AS (SELECT {key}, category, s, row_number() OVER (PARTITION BY {key} ORDER BY s DESC, ord) AS nth FROM sums)
      SELECT {key}, CAST(s AS INTEGER) AS score, CASE WHEN s > {over} THEN category ELSE '{default}' END AS category FROM best WHERE nth = 1"""


@query(_classified_sql(classify.CATEGORIES, "documents", "doc_id", "source", "text", 2, "uncategorized", None))
def classify_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.classify(_t(spark, sf_dir, "documents"), F.col("source"), F.col("text")).select("doc_id", "score", "category")


@query(_classified_sql(_SMALL, "documents", "doc_id", "source", "text", 2, "uncategorized", None))
def classify_small_taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.classify(_t(spark, sf_dir, "documents"), F.col("source"), F.col("text"), _SMALL).select("doc_id", "score", "category")


@query(_classified_sql(classify.LEGACY_CATEGORIES, "pages", "page_id", "url", "html", 2, "uncategorized", None))
def classify_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.classify(_t(spark, sf_dir, "pages"), F.col("url"), F.col("html"), classify.LEGACY_CATEGORIES).select("page_id", "score", "category")


@query(_classified_sql(classify.LEGACY_CATEGORIES, "pages", "page_id", "url", "html", 0, "general", 10))
def classify_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.classify_capped(_t(spark, sf_dir, "pages"), F.col("url"), F.col("html")).select("page_id", "score", "category")


# ---------------------------------------------------------------- names and hashes
@query("SELECT doc_id, md5(text) AS hash FROM documents")
def content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "documents").select("doc_id", text.content_hash(F.col("text")).alias("hash"))


@query("SELECT page_id, left(translate(url, ':/.', '___'), 100) || '.md' AS filename FROM pages")
def safe_filename(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "pages").select("page_id", text.safe_filename(F.col("url")).alias("filename"))


@query(r"""SELECT page_id, left(replace(h, '.', '_') || '_' || CASE WHEN p = '' THEN 'index' ELSE p END, 100) AS filename FROM (
  SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS h, replace(trim(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/'), '/', '_') AS p FROM pages)""")
def legacy_filename(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "pages").select("page_id", text.legacy_filename(F.col("url")).alias("filename"))


@query("SELECT doc_id, 'Title: ' || source || chr(10) || 'Content: ' || text AS training FROM documents")
def training_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "documents").select("doc_id", render.training_text(F.col("source"), F.col("text")).alias("training"))


# ---------------------------------------------------------------- SimHash
_FP = r"""w AS (
  SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0B\f\r]+')) AS w FROM documents) WHERE w <> '' GROUP BY ALL
), v AS (
  SELECT w, list_reduce(list_prepend(14695981039346656037::uhugeint, list_transform(generate_series(1, length(hx) // 2), lambda i: ('0x' || substr(hx, 2 * i - 1, 2))::int::uhugeint)),
    lambda a, b: (xor(a, b) * 1099511628211::uhugeint) % 18446744073709551616::uhugeint)::ubigint AS h
  FROM (SELECT w, hex(encode(w)) AS hx FROM (SELECT DISTINCT w FROM w))
), s AS (SELECT doc_id, b, sum(CASE WHEN (h >> b) & 1 = 1 THEN n ELSE -n END) AS t FROM w JOIN v USING (w), range(64) r(b) GROUP BY ALL),
fps AS (
  SELECT doc_id, (f - CASE WHEN f >= 9223372036854775808 THEN 18446744073709551616::hugeint ELSE 0 END)::bigint AS fp
  FROM (SELECT d.doc_id, coalesce(sum(CASE WHEN t > 0 THEN (1::hugeint << b::int) ELSE 0 END), 0)::hugeint AS f FROM documents d LEFT JOIN s USING (doc_id) GROUP BY d.doc_id)
)"""


@query(f"WITH {_FP} SELECT doc_id, fp FROM fps")
def simhash_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.fingerprints(_t(spark, sf_dir, "documents"), "doc_id", F.col("text"))


@query(f"WITH {_FP} SELECT doc_id, fp FROM fps")
def simhash_builtin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.fingerprints_sql(_t(spark, sf_dir, "documents"), "doc_id", F.col("text"))


@query(f"WITH {_FP.replace('fps AS (', 'fps AS MATERIALIZED (')} SELECT x.doc_id AS a, y.doc_id AS b, CAST(bit_count(xor(x.fp, y.fp)) AS INTEGER) AS dist FROM fps x JOIN fps y ON x.doc_id < y.doc_id AND bit_count(xor(x.fp, y.fp)) <= 3")
def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_pairs(simhash_fingerprint(spark, sf_dir), "doc_id")


@query(f"WITH {_FP} SELECT doc_id, fp, min(doc_id) OVER w AS first_key, count(*) OVER w AS n FROM fps WINDOW w AS (PARTITION BY fp)")
def equal_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_classes(simhash_fingerprint(spark, sf_dir), "doc_id")


# ---------------------------------------------------------------- link graph
_EDGES = r"""edges AS MATERIALIZED (SELECT src, dst FROM (
  SELECT url AS src, CASE WHEN regexp_matches(h, '^https?://') THEN h WHEN starts_with(h, '//') THEN regexp_extract(url, '^(https?:)', 1) || h
    WHEN starts_with(h, '/') THEN regexp_extract(url, '^(https?://[^/?#]+)', 1) || h END AS dst
  FROM (SELECT url, split_part(unnest(regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1)), '#', 1) AS h FROM pages)) WHERE dst IS NOT NULL)"""
_NODES = "nodes AS MATERIALIZED (SELECT url AS id FROM pages UNION SELECT src FROM edges UNION SELECT dst FROM edges)"


def _edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _t(spark, sf_dir, "pages").select(F.col("url").alias("src"), F.explode(html.hrefs(F.col("html"))).alias("href"))
    return found.select("src", url.resolve_simple(F.col("src"), F.col("href")).alias("dst")).filter("dst is not null")


def _nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.node_set(_t(spark, sf_dir, "pages"), _edges(spark, sf_dir))


@query(f"WITH {_EDGES} SELECT src, dst FROM edges")
def link_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _edges(spark, sf_dir)


@query(f"WITH {_EDGES} SELECT src, dst FROM edges")
def link_edges_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _t(spark, sf_dir, "pages").select(F.col("url").alias("src"), F.explode(html.hrefs(F.col("html"))).alias("href"))
    return found.select("src", url.resolve(F.col("src"), F.col("href")).alias("dst"))


@query(f"WITH {_EDGES} SELECT src, count(*) AS out_degree FROM edges GROUP BY src")
def out_degree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.out_degrees(_edges(spark, sf_dir))


@query(f"WITH {_EDGES}, {_NODES} SELECT id FROM nodes")
def node_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nodes(spark, sf_dir)


@query(f"WITH {_EDGES}, {_NODES} SELECT id FROM nodes WHERE id NOT IN (SELECT src FROM edges)")
def dangling_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.dangling(_nodes(spark, sf_dir), _edges(spark, sf_dir))


def _pagerank_ctes(rounds: int = 20) -> str:
    out = [
        _EDGES,
        _NODES,
        "deg AS MATERIALIZED (SELECT src, count(*) AS k FROM edges GROUP BY src)",
        "n AS MATERIALIZED (SELECT count(*)::double AS n FROM nodes)",
        "ends AS MATERIALIZED (SELECT id FROM nodes WHERE id NOT IN (SELECT src FROM edges))",
        "r0 AS MATERIALIZED (SELECT id, 1.0::double AS rank FROM nodes)",
    ]
    for k in range(1, rounds + 1):
        p = f"r{k - 1}"
        out.append(f"""r{k} AS MATERIALIZED (SELECT nodes.id, 0.15 + 0.85 * (SELECT coalesce(sum(rank), 0) FROM {p} WHERE id IN (SELECT id FROM ends)) / (SELECT n FROM n) + 0.85 * coalesce(got, 0) AS rank
          FROM nodes LEFT JOIN (SELECT dst AS id, sum(rank / k) AS got FROM edges JOIN {p} ON {p}.id = src JOIN deg USING (src) GROUP BY dst) g ON g.id = nodes.id)""")
    moves = " UNION ALL ".join(f"SELECT {k} AS k, (SELECT max(abs(a.rank - b.rank)) FROM r{k} a JOIN r{k - 1} b USING (id)) AS d" for k in range(1, rounds + 1))
    out.append(f"stop AS MATERIALIZED (SELECT coalesce(min(k) FILTER (WHERE d < 1e-6), {rounds}) AS k FROM ({moves}))")
    out.append("ranks AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT id, rank FROM r{k} WHERE (SELECT k FROM stop) = {k}" for k in range(1, rounds + 1)) + ")")
    return ", ".join(out)


@query(f"WITH {_pagerank_ctes()} SELECT id, round(rank, 6) AS rank FROM ranks")
def pagerank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.pagerank(_nodes(spark, sf_dir), _edges(spark, sf_dir)).select("id", F.round("rank", 6).alias("rank"))


@query(f"WITH {_pagerank_ctes()} SELECT id, round(rank, 6) AS rank FROM ranks ORDER BY round(rank, 9) DESC, id LIMIT 10")
def pagerank_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = graph.pagerank(_nodes(spark, sf_dir), _edges(spark, sf_dir)).withColumn("rank", F.round("rank", 9))
    return graph.top_ranks(ranks).select("id", F.round("rank", 6).alias("rank"))


_PRIORITY = f"WITH {_pagerank_ctes()}, ranked AS (SELECT page_id, url, html, round(coalesce(rank, 1.0), 6) AS pagerank FROM pages LEFT JOIN ranks ON id = url)"


@query(f"{_PRIORITY} SELECT page_id, pagerank, CASE WHEN pagerank > 0.9 THEN 'high' ELSE 'normal' END AS priority FROM ranked")
def page_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = graph.pagerank(_nodes(spark, sf_dir), _edges(spark, sf_dir))
    return render.with_rank(_t(spark, sf_dir, "pages"), ranks, high=0.9).select("page_id", "pagerank", "priority")


@query(f"{_PRIORITY} SELECT page_id, pagerank, CASE WHEN pagerank > 5.0 THEN 'high' ELSE 'normal' END AS priority FROM ranked")
def page_priority_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = graph.pagerank(_nodes(spark, sf_dir), _edges(spark, sf_dir))
    return render.with_rank(_t(spark, sf_dir, "pages"), ranks).select("page_id", "pagerank", "priority")


@query(
    f"""{_PRIORITY} SELECT 'uncategorized' AS category, left(translate(url, ':/.', '___'), 100) || '.md' AS filename,
  '---' || chr(10) || 'url: ' || url || chr(10) || 'title: ' || t || chr(10) || 'category: uncategorized' || chr(10) || 'pagerank_score: ' || printf('%.6f', pagerank) || chr(10)
  || 'priority: ' || CASE WHEN pagerank > 5.0 THEN 'high' ELSE 'normal' END || chr(10) || '---' || chr(10) || chr(10) || '# ' || t || chr(10) || chr(10) || html AS md
  FROM (SELECT *, coalesce(nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), ''), 'No Title') AS t FROM ranked)"""
)
def render_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = graph.pagerank(_nodes(spark, sf_dir), _edges(spark, sf_dir))
    pages = _t(spark, sf_dir, "pages").select("url", html.title_text(F.col("html")).alias("title"), F.lit("").alias("category"), F.col("html").alias("content"))
    return render.markdown(render.with_rank(pages, ranks))


# ---------------------------------------------------------------- state
_STATE = "state AS (SELECT d.doc_id, CASE WHEN quality = 0 THEN md5('') ELSE md5(text) END AS hash FROM documents d JOIN labels USING (doc_id))"


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents as the state of an earlier run; those of quality 0 had other content then."""
    docs = _t(spark, sf_dir, "documents").join(_t(spark, sf_dir, "labels"), "doc_id")
    return docs.select(F.col("doc_id").alias("url"), F.when(F.col("quality") == 0, F.md5(F.lit(""))).otherwise(F.md5("text")).alias("hash"), F.col("lang").alias("category"), F.to_timestamp(F.lit("2024-01-01")).alias("last_crawled"))


@query(f"WITH {_STATE} SELECT d.doc_id AS url, CASE WHEN s.hash IS NULL THEN 'NEW' WHEN s.hash <> md5(text) THEN 'UPDATED' ELSE 'UNCHANGED' END AS status FROM documents d LEFT JOIN state s USING (doc_id)")
def change_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = state.with_hash(_t(spark, sf_dir, "documents").withColumnRenamed("doc_id", "url"), F.col("text"))
    return state.change_status(pages, _stored(spark, sf_dir)).select("url", "status")


@query(f"""WITH {_STATE} SELECT d.doc_id AS url, md5(text) AS hash, lang AS category,
  CASE WHEN s.hash IS NULL OR s.hash <> md5(text) THEN TIMESTAMP '{AS_OF}' ELSE TIMESTAMP '2024-01-01' END AS last_crawled FROM documents d LEFT JOIN state s USING (doc_id)""")
def state_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = state.with_hash(_t(spark, sf_dir, "documents").select(F.col("doc_id").alias("url"), "text", F.col("lang").alias("category")), F.col("text"))
    changed = state.change_status(pages, _stored(spark, sf_dir))
    rows = changed.filter("status <> 'UNCHANGED'").select("url", "hash", "category", F.to_timestamp(F.lit(AS_OF)).alias("last_crawled"))
    return state.upsert(_stored(spark, sf_dir), rows, "url")


@query("""WITH o AS (SELECT user_id, ts, event_id FROM events WHERE event_type IN ('view', 'click')), n AS (SELECT user_id, ts, event_id FROM events WHERE event_type = 'purchase'),
  ln AS (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1), lo AS (SELECT * FROM o QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
  SELECT * FROM ln UNION ALL SELECT * FROM lo WHERE user_id NOT IN (SELECT user_id FROM ln)""")
def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _t(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    old = state.latest(events.filter("event_type in ('view', 'click')").drop("event_type"), "user_id", "ts", "event_id")
    return state.upsert(old, events.filter("event_type = 'purchase'").drop("event_type"), "user_id", "ts", "event_id")


@query("SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def delete_gone(spark: SparkSession, sf_dir: str) -> DataFrame:
    recheck = _t(spark, sf_dir, "labels").select(F.col("doc_id").alias("url"), F.when(F.col("toxic") == 1, 404).otherwise(200).alias("status"))
    docs = _t(spark, sf_dir, "documents").select(F.col("doc_id").alias("url"), "lang")
    return state.delete(docs, state.gone(recheck), "url").select(F.col("url").alias("doc_id"), "lang")


@query(f"SELECT user_id, max(ts) AS ts, (TIMESTAMP '{AS_OF}' - max(ts)) < INTERVAL 7 DAYS AS fresh FROM events WHERE event_type = 'error' GROUP BY user_id")
def ttl_fresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = _t(spark, sf_dir, "events").filter("event_type = 'error'").groupBy("user_id").agg(F.max("ts").cast("timestamp").alias("ts"))
    return last.withColumn("fresh", state.is_fresh(F.col("ts"), F.to_timestamp(F.lit(AS_OF)))).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("SELECT c_custkey AS url FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS t FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey WHERE coalesce(t, TIMESTAMP '1970-01-01') < TIMESTAMP '1998-01-01'")
def stale_suspects(spark: SparkSession, sf_dir: str) -> DataFrame:
    visited = _t(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("url")).agg(F.max("o_orderdate").cast("timestamp").alias("visited_ts"))
    return state.stale_suspects(_t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("url")), visited, F.to_timestamp(F.lit("1998-01-01")))


@query("SELECT doc_id AS url, CASE WHEN toxic = 0 THEN 'recovered' ELSE 'surviving' END AS fate FROM labels")
def recover_blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = _t(spark, sf_dir, "labels").select(F.col("doc_id").alias("url"), F.when(F.col("toxic") == 0, 200).otherwise(500).alias("status"))
    back, left = state.recover(labels.select("url"), labels)
    return back.withColumn("fate", F.lit("recovered")).union(left.withColumn("fate", F.lit("surviving")))


@query("SELECT doc_id AS url FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def restored_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (_t(spark, sf_dir, x).select(F.col("doc_id").alias("url")) for x in ("documents", "labels"))
    return state.restored_frontier(docs, labels)


@query("""SELECT CAST(src AS INTEGER) AS src, pos, url FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY src, pos) AS nth FROM (
  SELECT 0 AS src, event_id AS pos, user_id AS url FROM events WHERE event_type = 'view' UNION ALL SELECT 1, event_id, user_id FROM events WHERE event_type = 'click')) WHERE nth = 1""")
def merge_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _t(spark, sf_dir, "events").select(F.col("event_id").alias("pos"), F.col("user_id").alias("url"), "event_type")
    return state.merged_in_order(events.filter("event_type = 'view'"), events.filter("event_type = 'click'"))


# ---------------------------------------------------------------- frontier
_HOST = "regexp_extract(dst, '^[A-Za-z]+://([^/?#]*)', 1)"
_ACTION = f"""acts AS (SELECT dst AS url, CASE WHEN dst IN (SELECT url FROM pages WHERE contains(url, '?')) THEN 'fresh' WHEN dst IN (SELECT url FROM pages) THEN 'blacklisted'
  WHEN NOT (ends_with({_HOST}, '{ROOT}') AND regexp_matches(dst, '^https?://')) THEN 'offscope' WHEN regexp_matches(dst, '\\.(css|js|png|jpg|pdf)$') THEN 'asset' ELSE 'enqueue' END AS action FROM edges)"""


def _actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _t(spark, sf_dir, "pages").select("url")
    links = _edges(spark, sf_dir).select(F.col("dst").alias("url"))
    return frontier.link_actions(links, pages.withColumn("fresh", F.col("url").contains("?")), pages, ROOT)


@query(f"WITH {_EDGES}, {_ACTION} SELECT action AS reason, count(*) AS n FROM acts GROUP BY action")
def link_drop_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fetchlog.counters(_actions(spark, sf_dir), "action")


@query(f"WITH {_EDGES}, {_ACTION} SELECT DISTINCT url FROM acts WHERE action = 'enqueue'")
def frontier_next(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frontier.next_frontier(_actions(spark, sf_dir))


@query(f"WITH {_EDGES}, {_ACTION} SELECT DISTINCT url FROM acts WHERE action = 'enqueue' ORDER BY url LIMIT 50")
def frontier_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frontier.next_frontier(_actions(spark, sf_dir), cap=50)


@query(f"WITH {_EDGES}, {_ACTION} SELECT DISTINCT url FROM acts WHERE action = 'enqueue' ORDER BY url LIMIT 30")
def frontier_capped_later(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frontier.next_frontier(_actions(spark, sf_dir), cap=50, scanned=20)


@query("""SELECT user_id AS url, min(ts) AS enqueued_at FROM events WHERE event_type <> 'error' GROUP BY user_id ORDER BY min(ts), user_id LIMIT 40""")
def frontier_fifo(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _t(spark, sf_dir, "events").select(F.col("user_id").alias("url"), "ts", F.when(F.col("event_type") == "error", "asset").otherwise("enqueue").alias("action"))
    return frontier.fifo_frontier(events, "ts", cap=50, scanned=10)


@query(f"""SELECT user_id AS url, CASE WHEN bool_or(event_type = 'click') THEN TIMESTAMP '{AS_OF}' ELSE max(ts) END AS visited_ts FROM events WHERE event_type IN ('view', 'click') GROUP BY user_id""")
def visited_at_enqueue(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _t(spark, sf_dir, "events")
    seen = events.filter("event_type = 'view'").groupBy(F.col("user_id").alias("url")).agg(F.max("ts").alias("visited_ts"))
    return frontier.marked_visited(seen, events.filter("event_type = 'click'").select(F.col("user_id").alias("url")), F.to_timestamp(F.lit(AS_OF)).cast(events.schema["ts"].dataType))


@query("SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS ordinal FROM events QUALIFY row_number() OVER (ORDER BY ts, event_id) % 10 = 0")
def checkpoint_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.checkpoint_marks(_t(spark, sf_dir, "events").select("event_id", "ts"), "ts", "event_id").select("event_id", "ordinal")


@query(f"WITH {_STATE} SELECT d.doc_id AS url, lang AS category FROM documents d JOIN state s USING (doc_id) WHERE s.hash <> md5(text)")
def moved_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = _stored(spark, sf_dir)
    pages = state.with_hash(_t(spark, sf_dir, "documents").select(F.col("doc_id").alias("url"), "text", F.col("lang").alias("category")), F.col("text"))
    changed = state.change_status(pages.withColumn("category", F.concat("category", F.lit("!"))), old).filter("status = 'UPDATED'")
    return state.moved_or_gone(changed, old)


@query(f"WITH {_EDGES} SELECT dst AS url FROM edges WHERE dst NOT IN (SELECT url FROM pages)")
def blacklist_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frontier.blacklist_filter(_edges(spark, sf_dir).select(F.col("dst").alias("url")), _t(spark, sf_dir, "pages"))


_URLHOST = "regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)"


@query(f"SELECT DISTINCT host FROM (SELECT {_URLHOST} AS host FROM pages UNION ALL SELECT 'www.{ROOT}' UNION ALL SELECT 'vpn.{ROOT}')")
def seed_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    hosts = _t(spark, sf_dir, "pages").select(url.host_of(F.col("url")).alias("host"))
    return frontier.seed_union(hosts, spark.createDataFrame([(f"www.{ROOT}",), (f"vpn.{ROOT}",)], "host string"))


@query(f"SELECT DISTINCT host FROM (SELECT {_URLHOST} AS host FROM pages) WHERE ends_with(host, '{ROOT}') AND NOT regexp_matches(host, '{'|'.join(url.IGNORED_HOST_PARTS)}')")
def subdomain_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frontier.kept_hosts(_t(spark, sf_dir, "pages").select(url.host_of(F.col("url")).alias("host")).distinct(), ROOT)


@query(f"SELECT page_id, url, CAST(nth AS INTEGER) AS nth FROM (SELECT page_id, url, row_number() OVER (PARTITION BY {_URLHOST} ORDER BY page_id, url) AS nth FROM pages) WHERE nth <= 10")
def per_host_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frontier.first_per_host(_t(spark, sf_dir, "pages").select("page_id", "url"), "page_id")


_STEPS = "steps AS MATERIALIZED (SELECT DISTINCT src, dst FROM (SELECT lag(user_id) OVER (PARTITION BY event_type, CAST(ts AS DATE) ORDER BY event_id) AS src, user_id AS dst FROM events) WHERE src IS NOT NULL)"


@query(f"""WITH RECURSIVE {_STEPS}, w(url, wave) AS (SELECT min(user_id), 0 FROM events UNION SELECT dst, wave + 1 FROM w JOIN steps ON src = url WHERE wave < 10)
  SELECT url, CAST(min(wave) AS INTEGER) AS wave FROM w GROUP BY url""")
def crawl_waves(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _t(spark, sf_dir, "events")
    before = F.lag("user_id").over(Window.partitionBy("event_type", F.to_date("ts")).orderBy("event_id"))
    steps = events.select(before.alias("src"), F.col("user_id").alias("dst")).filter("src is not null").distinct()
    return frontier.crawl_waves(events.agg(F.min("user_id").alias("url")), steps)


# ---------------------------------------------------------------- fetch log
_LOG = """log AS (SELECT user_id AS url, ts AS at, event_id, CAST(row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS INTEGER) AS attempt,
  CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN 200 WHEN 'click' THEN 404 WHEN 'signup' THEN 503 ELSE 429 END AS status, CASE WHEN event_type = 'error' THEN 'timeout' END AS error, CAST(ts AS DATE) AS day FROM events)"""


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _t(spark, sf_dir, "events")
    kind = F.col("event_type")
    status = F.when(kind == "error", None).when(kind == "view", 200).when(kind == "click", 404).when(kind == "signup", 503).otherwise(429)
    day = F.to_date("ts")
    attempt = F.row_number().over(Window.partitionBy("user_id", day).orderBy("ts", "event_id"))
    return events.select(F.col("user_id").alias("url"), F.col("ts").alias("at"), "event_id", attempt.alias("attempt"), status.alias("status"), F.when(kind == "error", "timeout").alias("error"), day.alias("day"))


@query(f"""WITH {_LOG}, last AS (SELECT url || '/' || strftime(day, '%Y-%m-%d') AS url, max(attempt) AS attempts, arg_max(coalesce(status, 0), attempt) AS status FROM log GROUP BY ALL)
  SELECT url, attempts, nullif(status, 0) AS status, CASE WHEN status = 200 THEN 'return' WHEN attempts >= 4 THEN 'blacklist' ELSE 'retry' END AS action,
  CASE WHEN status <> 200 AND attempts < 4 THEN CASE attempts WHEN 1 THEN 30 WHEN 2 THEN 60 ELSE 120 END END AS wait FROM last""")
def retry_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _log(spark, sf_dir).withColumn("url", F.concat_ws("/", "url", F.date_format("day", "yyyy-MM-dd")))
    return fetchlog.outcomes(log)


@query(f"WITH {_LOG} SELECT CASE WHEN error IS NOT NULL THEN 'network_error' ELSE 'http_' || status END AS reason, count(*) AS n FROM log WHERE error IS NOT NULL OR status <> 200 GROUP BY reason")
def failure_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _log(spark, sf_dir).withColumn("reason", fetchlog.failure_reason(F.col("status"), F.col("error")))
    return fetchlog.counters(log, "reason")


@query("""SELECT event_id, user_id, round(max(a - 600.0 * k) OVER (PARTITION BY user_id ORDER BY k ROWS UNBOUNDED PRECEDING) + 600.0 * k, 3) AS slot
  FROM (SELECT event_id, user_id, epoch_us(ts) / 1e6 AS a, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events)""")
def rate_limit_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _t(spark, sf_dir, "events").select("event_id", "user_id", (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("a"))
    return fetchlog.schedule(events, "user_id", "a", 600.0, "event_id").select("event_id", "user_id", F.round("slot", 3).alias("slot"))


@query("""WITH g AS (SELECT user_id, max(ts) FILTER (WHERE event_type <> 'error') AS ok FROM events GROUP BY user_id)
  SELECT user_id AS domain, count(*) FILTER (WHERE event_type = 'error' AND (ok IS NULL OR ts > ok)) AS failures, count(*) FILTER (WHERE event_type = 'error' AND (ok IS NULL OR ts > ok)) < 3 AS alive FROM events JOIN g USING (user_id) GROUP BY user_id""")
def dns_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fetchlog.dns_gate(_t(spark, sf_dir, "events").select(F.col("user_id").alias("domain"), F.col("ts").alias("at"), (F.col("event_type") != "error").alias("ok")))


@query(f"SELECT {_URLHOST} AS host, count(*) AS n FROM pages GROUP BY host")
def host_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "pages").groupBy(url.host_of(F.col("url")).alias("host")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""SELECT page_id, CASE WHEN regexp_matches(url, '{'|'.join(url.BROWSER_PARTS)}') THEN 'browser' WHEN length(html) < 500 THEN 'browser_fallback' ELSE 'static' END AS route,
  CASE WHEN length(html) > 100 THEN 'process' WHEN html = '' THEN 'empty_html' ELSE 'html_too_short' END AS gate FROM pages""")
def fetch_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    route = url.fetch_route(F.col("url"), F.col("html"), F.lit(False), F.lit(False), F.lit(0))
    return _t(spark, sf_dir, "pages").select("page_id", route.alias("route"), fetchlog.html_gate(F.col("html")).alias("gate"))


# ---------------------------------------------------------------- validation
_LINES = """lines AS (SELECT doc_id, CASE WHEN quality IS NULL THEN to_json({'url': source, 'title': lang, 'content': text})::varchar
  WHEN quality = 0 THEN '{bad' WHEN toxic = 1 THEN to_json({'url': source, 'title': lang})::varchar ELSE '  ' END AS line FROM documents LEFT JOIN labels USING (doc_id)),
  checked AS (SELECT doc_id, CASE WHEN trim(line) = '' THEN 'blank' WHEN NOT json_valid(line) THEN 'invalid_json'
  WHEN NOT list_has_all(CASE WHEN json_valid(line) THEN json_keys(line) END, ['url', 'title', 'content']) THEN 'missing_keys' END AS skip_reason FROM lines)"""


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _t(spark, sf_dir, "documents").join(_t(spark, sf_dir, "labels"), "doc_id", "left")
    part = [F.col("source").alias("url"), F.col("lang").alias("title")]
    line = (
        F.when(F.col("quality").isNull(), F.to_json(F.struct(*part, F.col("text").alias("content")))).when(F.col("quality") == 0, "{bad").when(F.col("toxic") == 1, F.to_json(F.struct(*part))).otherwise("  ")
    )
    return validate.validated(docs.select("doc_id", line.alias("value")))


@query(f"WITH {_LINES} SELECT doc_id, skip_reason FROM checked")
def validate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked(spark, sf_dir).select("doc_id", "skip_reason")


@query(f"WITH {_LINES} SELECT count(*) AS total, count(*) FILTER (WHERE skip_reason IS NULL) AS valid, count(skip_reason) AS skipped FROM checked")
def validation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.summary(_checked(spark, sf_dir))


# ---------------------------------------------------------------- HTML
@query("SELECT page_id, coalesce(nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), ''), 'No Title') AS title FROM pages")
def page_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "pages").select("page_id", html.title_text(F.col("html")).alias("title"))


@query()
def html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.parse_pages(_t(spark, sf_dir, "pages"), "example.")


@query()
def html_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.page_metadata(_t(spark, sf_dir, "pages"))


@query()
def extraction_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extraction_report(_t(spark, sf_dir, "pages"))


# ---------------------------------------------------------------- model routing
_RULES = {"licensed": "university policy and code of conduct", "password": "login page or access denied error", "the ": "university news, press release or story"}


@query("""SELECT doc_id, CASE WHEN contains(t, 'licensed') THEN 'policies' WHEN contains(t, 'password') THEN 'trash' WHEN contains(t, 'the ') THEN 'news' ELSE 'about' END AS directory,
  CASE WHEN length(text) < 150 THEN 'delete_short' WHEN NOT contains(t, 'licensed') AND contains(t, 'password') THEN 'delete' WHEN contains(t, 'licensed') OR contains(t, 'the ') THEN 'move' ELSE 'keep' END AS ai_action
  FROM (SELECT doc_id, text, lower(left(text, 500)) AS t FROM documents)""")
def ai_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _t(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("md"))
    return ai.reorganise(files, ai.keyword_scorer(_RULES)).select("doc_id", "directory", "ai_action")
