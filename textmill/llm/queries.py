"""The registered queries of this package, one per operator, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from textmill.llm import (
    conversations,
    decontamination,
    fingerprints,
    html_extraction,
    jaccard_trees,
    lm_scoring,
    merkle,
    near_dedup,
    packing,
    secrets,
    token_counts,
    toxicity,
    url_filters,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# 1: token counts -------------------------------------------------------------


@query
def op1_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    """The histogram of encoded lengths of all documents."""
    return token_counts.length_histogram(token_counts.with_token_count(table(spark, sf, "documents").select("text")))


# 2: document fingerprints ---------------------------------------------------


@query
def op2_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    """Fingerprints of every document and its edited text."""
    return fingerprints.edited_likeness(table(spark, sf, "documents").select("doc_id", "text"))


# 3: secret scans -----------------------------------------------------------


@query
def op3_secret_scans(spark: SparkSession, sf: str) -> DataFrame:
    """Base spans of every document, by way of a fresh ledger."""
    documents = table(spark, sf, "documents").select("doc_id", "text")
    ledger = secrets.update_ledger(documents)
    found = secrets.findings(documents, ledger)

    def count(kind: str):
        return F.size(F.filter("secret_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    spans = secrets.span_string(F.col("secret_spans"))
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(spans, 256).alias("base_sha256"), spans.alias("spans"),
    )


def _secret_sql(rank: int, kind: str, pattern: str, group: int, shortest: int) -> str:
    p = pattern.replace("'", "''")
    return rf"""list_filter(list_transform(range(1, len(regexp_extract_all(t, '{p}')) + 1), lambda i: {{
      'start': (list_sum(list_transform(string_split_regex(t, '{p}')[1:i], lambda x: length(x)))
                + coalesce(list_sum(list_transform(regexp_extract_all(t, '{p}')[1:i - 1], lambda x: length(x))), 0))::BIGINT,
      'rank': {rank}, 'kind': '{kind}',
      'size': length(regexp_extract_all(t, '{p}')[i]),
      'part': length(regexp_extract_all(t, '{p}', {group})[i])}}), lambda s: s.part >= {shortest})"""


_ASSIGN_SQL = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ORACLES["op3_secret_scans"] = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS (SELECT doc_id, {_secret_sql(0, 'assign', _ASSIGN_SQL, 2, 12)} AS a,
  {_secret_sql(1, 'access', 'AKIA[A-Z0-9]+', 0, 18)} AS k,
  {_secret_sql(2, 'hex', '[0-9a-f]{16,}', 0, 16)} AS h FROM d),
joined AS (SELECT *, coalesce(array_to_string(list_transform(list_sort(list_concat(list_concat(a, k), h)),
  lambda s: s.kind || ':' || s.start || ':' || (s.start + s.size)), ','), '') AS spans FROM found)
SELECT doc_id, len(a)::BIGINT AS n_assign, len(k)::BIGINT AS n_access, len(h)::BIGINT AS n_hex,
  sha256(spans) AS base_sha256, spans FROM joined
"""


# 4: benchmark decontamination -------------------------------------------------


@query
def op4_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    """Every benchmark item found in every document."""
    documents = table(spark, sf, "documents").select("doc_id", "text")
    return decontamination.find_leaks(documents, table(spark, sf, "benchmark"))


# 5: near-deduplication ------------------------------------------------------


@query
def op5_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """The near-duplicate class of every document, named by its smallest doc_id."""
    classes = near_dedup.near_classes(table(spark, sf, "documents").select("doc_id", "text"))
    return classes.select(F.col("id").alias("doc_id"), "class_id")


# 6: LM scoring ---------------------------------------------------------------


@query
def op6_lm_scoring(spark: SparkSession, sf: str) -> DataFrame:
    """The stupid-backoff score of every document, counted over all documents."""
    scored = lm_scoring.score_corpus(table(spark, sf, "documents").select("doc_id", "text"))
    return scored.select(
        F.col("id").alias("doc_id"), "n_words", F.round("score", 6).alias("score"), F.round("per_word", 9).alias("per_word")
    )


# 7: URL filters ------------------------------------------------------------

URL_RULES = [
    url_filters.UrlRule("block", "net", "/"),
    url_filters.UrlRule("allow", "example.net", "/en/"),
    url_filters.UrlRule("block", "example.com", "/de/"),
    url_filters.UrlRule("allow", "org", "/fr/"),
]


@query
def op7_url_filters(spark: SparkSession, sf: str) -> DataFrame:
    """The verdict on every page's URL."""
    pages = table(spark, sf, "pages").select("page_id", "url")
    judged = url_filters.judge_urls(pages, url_filters.rule_table(spark, URL_RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


_RULES_SQL = ", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in URL_RULES)
ORACLES["op7_url_filters"] = f"""
WITH rules(verdict, host, path) AS (VALUES {_RULES_SQL}),
rest AS (SELECT page_id, url, CASE WHEN url IS NOT NULL AND contains(url, '://')
  THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
hosts AS (SELECT *, regexp_extract(rest, '^[^/?#]*') AS raw FROM rest),
parts AS (SELECT page_id, url, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM hosts),
fits AS (SELECT p.page_id, p.url, r.verdict, r.host || r.path AS rule FROM parts p JOIN rules r
  ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)),
best AS (SELECT page_id, url, max_by(rule, length(rule)) AS rule, max_by(verdict, length(rule)) AS verdict
  FROM fits GROUP BY page_id, url)
SELECT p.page_id, p.host, p.path, b.rule, coalesce(b.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN best b ON p.page_id = b.page_id AND p.url = b.url
"""


# 8: packing ----------------------------------------------------------------


@query
def op8_packing(spark: SparkSession, sf: str) -> DataFrame:
    """Every piece of every document in sequences of at most 2048 tokens."""
    return packing.pack_documents(table(spark, sf, "documents").select("doc_id", "text"))


# 9: HTML extraction ----------------------------------------------------------


@query
def op9_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    """The main text of every page."""
    pages = table(spark, sf, "pages").select("page_id", "url", "html")
    extracted = html_extraction.extract_text(pages, html_extraction.fit_labeller(pages)).drop("html")
    return extracted.withColumn("n_chars", F.length("text").cast("long"))


# 10: toxicity --------------------------------------------------------------


@query
def op10_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    """The toxicity score of every document."""
    documents = table(spark, sf, "documents").select("doc_id", "text")
    sample = toxicity.labelled_sample(documents, table(spark, sf, "labels"))
    scored = toxicity.score_texts(documents, toxicity.fit_model(sample))
    return scored.select(
        "doc_id", toxicity.held_out("doc_id").alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


# 11: Merkle manifest -------------------------------------------------------------

# DuckDB has no CRC-32: its table, and the digits of a text fed through it.
_CRC_TABLE = """list_transform(range(256), lambda n: list_reduce(list_concat([n], [0, 0, 0, 0, 0, 0, 0, 0]),
  lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))"""


def _crc_sql(text: str) -> str:
    return f"""xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, length({text}) + 1),
      lambda i: ascii(substr({text}, i, 1))::BIGINT)), lambda c, b: xor(c >> 8, crc_table[(xor(c, b) & 255) + 1])), 4294967295)"""


@query
def op11_merkle(spark: SparkSession, sf: str) -> DataFrame:
    """Proofs of all documents against the manifest, half of them with line ends deleted."""
    documents = table(spark, sf, "documents").select(*merkle.FIELDS)
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    return merkle.tampered_proofs(documents, F.when(even, F.replace("text", F.lit("\n"), F.lit(""))))


def _field_sql(name: str) -> str:
    return f"coalesce(strlen({name}::VARCHAR) || ':' || {name}, '-')"


ORACLES["op11_merkle"] = f"""
WITH RECURSIVE crc AS (SELECT {_CRC_TABLE} AS crc_table),
changed AS (SELECT *, CASE WHEN {_crc_sql('doc_id::VARCHAR')} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS cut
  FROM documents, crc),
leaves AS (SELECT doc_id, coalesce('.' || source, '') AS tree,
  sha256({' || '.join(map(_field_sql, merkle.FIELDS))}) AS leaf,
  sha256({' || '.join(map(_field_sql, [*merkle.FIELDS[:-1], 'cut']))}) AS tampered FROM changed),
placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
low(tree, lvl, pos, h, n) AS (
  SELECT tree, 0, pos, leaf, count(*) OVER (PARTITION BY tree) FROM placed
  UNION ALL
  SELECT tree, lvl + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (max(n) + 2) // 3
  FROM low WHERE n > 1 GROUP BY tree, lvl, pos // 3),
subroots AS (SELECT tree, h, lvl, row_number() OVER (ORDER BY tree) - 1 AS pos FROM low WHERE n = 1),
high(lvl, pos, h, n) AS (
  SELECT 0, pos, h, count(*) OVER () FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (max(n) + 2) // 3
  FROM high WHERE n > 1 GROUP BY lvl, pos // 3),
steps AS (
  SELECT p.tree, p.pos AS leaf_pos, l.lvl, l.lvl AS step, l.pos, l.h, p.pos // (3 ** l.lvl)::BIGINT AS own
  FROM placed p JOIN low l ON l.tree = p.tree AND l.n > 1 AND l.pos // 3 = p.pos // (3 ** (l.lvl + 1))::BIGINT
  UNION ALL
  SELECT p.tree, p.pos, h.lvl, s.lvl + h.lvl, h.pos, h.h, s.pos // (3 ** h.lvl)::BIGINT
  FROM placed p JOIN subroots s ON s.tree = p.tree
  JOIN high h ON h.n > 1 AND h.pos // 3 = s.pos // (3 ** (h.lvl + 1))::BIGINT),
levels AS (SELECT tree, leaf_pos, step, coalesce(string_agg(h, '' ORDER BY pos) FILTER (pos < own), '') AS l,
  coalesce(string_agg(h, '' ORDER BY pos) FILTER (pos > own), '') AS r FROM steps GROUP BY tree, leaf_pos, step),
proofs AS (SELECT tree, leaf_pos, list({{'l': l, 'r': r}} ORDER BY step) AS path FROM levels GROUP BY tree, leaf_pos),
folds AS (SELECT p.*, coalesce(path, []) AS path,
  list_reduce(list_concat([{{'l': tampered, 'r': ''}}], coalesce(path, [])),
    lambda a, s: {{'l': sha256(s.l || a.l || s.r), 'r': ''}}).l AS folded_root
  FROM placed p LEFT JOIN proofs q ON q.tree = p.tree AND q.leaf_pos = p.pos)
SELECT f.doc_id, f.leaf, s.h AS subroot, (SELECT h FROM high WHERE n = 1) AS root,
  sha256(coalesce(array_to_string(list_transform(f.path, lambda s: s.l || s.r), ''), '')) AS proof_sha256, folded_root,
  folded_root = (SELECT h FROM high WHERE n = 1) AS verified
FROM folds f JOIN subroots s ON s.tree = f.tree
"""


# 12: n-gram Jaccard join -----------------------------------------------------------


@query
def op12_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    """The component of every document under links of at least 80 % shared shingles."""
    joined = jaccard_trees.jaccard_components(table(spark, sf, "documents").select("doc_id", "text"))
    return joined.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id")


# Every pair of sets that share a shingle, counted through the shingle; then the closure of the links.
ORACLES["op12_jaccard_join"] = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^ 	-]+') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM w),
t AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS c
  FROM t a JOIN t b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared WHERE 100 * c >= 80 * (na + nb - c)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT a, b FROM ways UNION SELECT r.a, w.b FROM reach r JOIN ways w ON w.a = r.b)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, least(s.doc_id, coalesce(m.low, s.doc_id)) AS component_id
FROM s LEFT JOIN (SELECT a, min(b) AS low FROM reach GROUP BY a) m ON m.a = s.doc_id
"""


# 13: conversation structure repair ------------------------------------------------


@query
def op13_conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    """Faults, cheapest edits and repaired digest of every damaged conversation."""
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    return conversations.repair_report(conversations.damage(rows), rows)


_WHITE = r"[\x20\x09-\x0D]*"
# Steps of (s?(ua)+)? before a turn: inserts (state, edits, lines, cost, state after), then the turn's own edit.
_INSERTS = """(0, '', '', 0, 0), (1, '', '', 0, 1), (2, '', '', 0, 2), (3, '', '', 0, 3),
  (0, 'I', 'user:' || chr(10), 5, 2), (1, 'I', 'user:' || chr(10), 5, 2), (3, 'I', 'user:' || chr(10), 5, 2),
  (2, 'I', 'assistant:' || chr(10), 5, 3), (0, 'II', 'user:' || chr(10) || 'assistant:' || chr(10), 10, 3),
  (1, 'II', 'user:' || chr(10) || 'assistant:' || chr(10), 10, 3)"""
ORACLES["op13_conversation_repair"] = f"""
WITH RECURSIVE crc AS (SELECT {_CRC_TABLE} AS crc_table),
keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
dealt AS (SELECT *, {_crc_sql('k')} % 20 AS f FROM keyed, crc),
damaged AS (SELECT coalesce('.' || conv_id, '') AS name, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
  CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM dealt, range(CASE WHEN f = 3 THEN 2 ELSE 1 END) WHERE f <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY turn NULLS FIRST, role, substr(sha256(text), 1, 32)) AS i
  FROM damaged),
seen AS (SELECT *, regexp_full_match(text, '{_WHITE}') AS blank,
  row_number() OVER (PARTITION BY name, role, text ORDER BY i) > 1 AS again,
  NOT regexp_matches(text, '[.!?]{_WHITE}$') AS unended, substr(role, 1, 1) AS initial,
  substr(lag(role) OVER (PARTITION BY name ORDER BY i), 1, 1) AS before FROM placed),
told AS (SELECT *, NOT blank AND again AS duplicate, NOT blank AND NOT again AND unended AS truncated FROM seen),
counts AS (SELECT name, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
  count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
  count(*) FILTER (i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM told GROUP BY name),
inserts(state, edits, lines, cost, after) AS (VALUES {_INSERTS}),
walk(name, i, state, best) AS (
  SELECT name, 0::BIGINT, 0, {{'cost': 0::BIGINT, 'audit': '', 'lines': ''}} FROM counts
  UNION ALL
  SELECT name, i, state, arg_min(way, {{'cost': way.cost, 'audit': way.audit}}) FROM (
    SELECT w.name, t.i, e.state, {{'cost': w.best.cost + n.cost + e.cost, 'audit': w.best.audit || n.edits || e.edit,
      'lines': w.best.lines || n.lines || e.line}} AS way
    FROM walk w JOIN told t ON t.name = w.name AND t.i = w.i + 1 JOIN inserts n ON n.state = w.state,
    unnest([
      {{'edit': 'D', 'state': n.after, 'cost': 2, 'line': '', 'fits': true}},
      {{'edit': 'K', 'state': CASE t.initial WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END, 'cost': CASE WHEN t.truncated THEN 5 ELSE 0 END,
        'line': t.role || ':' || t.text || chr(10),
        'fits': NOT t.blank AND NOT t.duplicate AND ((t.initial = 's' AND n.after = 0)
          OR (t.initial = 'u' AND n.after <> 2) OR (t.initial = 'a' AND n.after = 2))}},
      {{'edit': 'R', 'state': CASE WHEN n.after = 2 THEN 3 ELSE 2 END, 'cost': CASE WHEN t.truncated THEN 6 ELSE 1 END,
        'line': CASE WHEN n.after = 2 THEN 'assistant:' ELSE 'user:' END || t.text || chr(10),
        'fits': NOT t.blank AND NOT t.duplicate}}]) AS u(e)
    WHERE e.fits)
  GROUP BY name, i, state),
ended AS (SELECT w.name, arg_min({{'cost': w.best.cost + n.cost, 'audit': w.best.audit || n.edits, 'lines': w.best.lines || n.lines}},
  {{'cost': w.best.cost + n.cost, 'audit': w.best.audit || n.edits}}) AS best
  FROM walk w JOIN counts c ON c.name = w.name AND c.n = w.i JOIN inserts n ON n.state = w.state AND n.after IN (0, 3) GROUP BY w.name)
SELECT v.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
  coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal, coalesce(e.best.cost, 0) AS cost,
  coalesce(e.best.audit, '') AS audit, sha256(coalesce(substr(e.best.lines, 1, length(e.best.lines) - 1), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) v LEFT JOIN counts c ON c.name = coalesce('.' || v.conv_id, '')
LEFT JOIN ended e ON e.name = c.name
"""
