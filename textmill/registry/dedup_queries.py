"""Deduplication: copies, signatures, buckets, clusters, survivors.

Registered with 32-bit hashes, which SQL can follow; 64 bits is the default of
the operators themselves.
"""

from pyspark.sql import functions as F

from textmill.operators import dedup
from textmill.operators.near_pairs import near_dup_pairs
from textmill.operators.rows import chunk_text
from textmill.plans.stages import deduplication
from textmill.registry.base import DOCS, busy_docs, docs, query, words_sql

BUCKETS, PER = dedup.NUM_BUCKETS, dedup.HASHES_PER_BUCKET
COEFFICIENTS = ", ".join(
    f"({k}, {a}::BIGINT, {b}::BIGINT)" for k, (a, b) in enumerate(dedup.hash_coefficients(BUCKETS * PER, 32))
)



def signature_ctes(source: str = DOCS) -> str:
    return f"""WITH RECURSIVE w AS (SELECT id, {words_sql()} AS words FROM {source}),
 sh AS (SELECT DISTINCT id, ('0x' || substr(md5(array_to_string(words[i:i + 4], ' ')), 1, 8))::BIGINT AS h
   FROM (SELECT id, words, unnest(range(1, len(words) - 3)) AS i FROM w WHERE len(words) >= 5)),
 coef(k, a, b) AS (VALUES {COEFFICIENTS}),
 sig AS (SELECT id, k, min((a * h + b) % {dedup.PRIME_31}) AS v FROM sh CROSS JOIN coef GROUP BY id, k)"""


def band_ctes(source: str = DOCS) -> str:
    return signature_ctes(source) + f""",
 band AS (SELECT id, k // {PER} AS band, string_agg(v, ',' ORDER BY k) AS key FROM sig GROUP BY id, k // {PER}),
 head AS (SELECT *, min(id) OVER (PARTITION BY band, key, id % {dedup.BUCKET_SALTS}) AS h1, min(id) OVER (PARTITION BY band, key) AS h0 FROM band),
 edge AS (SELECT DISTINCT id AS src, h1 AS dst FROM head WHERE id <> h1 UNION SELECT DISTINCT id, h0 FROM head WHERE id = h1 AND id <> h0)"""


def cluster_ctes(source: str = DOCS) -> str:
    return band_ctes(source) + """,
 both_ways AS (SELECT src, dst FROM edge UNION SELECT dst, src FROM edge),
 reach(id, other) AS (SELECT src, dst FROM both_ways UNION SELECT reach.id, b.dst FROM reach JOIN both_ways b ON b.src = reach.other),
 cl AS (SELECT id, least(id, min(other)) AS cluster_id FROM reach GROUP BY id)"""


def verdict_ctes(source: str = DOCS) -> str:
    return cluster_ctes(source) + f""", first AS (SELECT id, min(id) OVER (PARTITION BY text) AS f FROM {source}),
 why AS (SELECT first.id, coalesce(CASE WHEN first.id <> f THEN 'exact' WHEN cl.id <> cluster_id THEN 'minhash' END, 'kept') AS verdict
   FROM first LEFT JOIN cl ON cl.id = first.id)"""


SIGNATURE_CTES, BAND_CTES, CLUSTER_CTES = signature_ctes(), band_ctes(), cluster_ctes()


def signatures(spark, sf):
    return dedup.signature(busy_docs(spark, sf).select("id", "text"), bit_precision=32)


def edges(spark, sf):
    salt = F.pmod(F.col("id"), F.lit(dedup.BUCKET_SALTS))
    return dedup.minhash_buckets(signatures(spark, sf).drop("text"), salt=salt)


def clusters(spark, sf):
    return dedup.cluster_components(edges(spark, sf))


@query("exact_dedup", f"SELECT min(id) AS id, text FROM {DOCS} GROUP BY text")
def exact_dedup(spark, sf):
    return dedup.exact_dedup(docs(spark, sf).select("id", "text"))


@query("minhash_signature", SIGNATURE_CTES + " SELECT id, string_agg(v, ',' ORDER BY k) AS signature FROM sig GROUP BY id")
def minhash_signature(spark, sf):
    out = signatures(spark, sf).where(F.size("signature") > 0)
    return out.select("id", F.array_join(F.col("signature").cast("array<string>"), ",").alias("signature"))


@query("minhash_signature_64")
def minhash_signature_64(spark, sf):
    return dedup.signature(busy_docs(spark, sf).select("id", "text")).select("id", "signature")


@query("minhash_buckets", BAND_CTES + " SELECT src, dst FROM edge")
def minhash_buckets(spark, sf):
    return edges(spark, sf)


@query("cluster_components", CLUSTER_CTES + " SELECT id, cluster_id FROM cl")
def cluster_components(spark, sf):
    return clusters(spark, sf)


@query(
    "minhash_filter",
    CLUSTER_CTES + f" SELECT id, lang, text FROM {DOCS} WHERE id NOT IN (SELECT id FROM cl WHERE id <> cluster_id)",
)
def minhash_filter(spark, sf):
    kept, _ = dedup.minhash_filter(docs(spark, sf).select("id", "lang", "text"), clusters(spark, sf))
    return kept


@query(
    "near_dup_survivors",
    CLUSTER_CTES + """, sets AS (SELECT DISTINCT id, array_to_string(words[i:i + 4], ' ') AS s
   FROM (SELECT id, words, unnest(range(1, len(words) - 3)) AS i FROM w WHERE len(words) >= 5)),
 n AS (SELECT id, count(*) AS n FROM sets GROUP BY id),
 pair AS (SELECT id, cluster_id FROM cl WHERE id <> cluster_id),
 common AS (SELECT p.id, p.cluster_id, count(b.s) AS c FROM pair p JOIN sets a ON a.id = p.id
   LEFT JOIN sets b ON b.id = p.cluster_id AND b.s = a.s GROUP BY p.id, p.cluster_id)
 SELECT c.id, c.cluster_id, c::DOUBLE / (na.n + nb.n - c)::DOUBLE AS jaccard FROM common c JOIN n na ON na.id = c.id JOIN n nb ON nb.id = c.cluster_id""",
)
def near_dup_survivors(spark, sf):
    return dedup.near_dup_overlap(docs(spark, sf), clusters(spark, sf))


@query(
    "near_dup_pairs_exact",
    f"""WITH w AS (SELECT id, min(id) OVER (PARTITION BY text) AS node, {words_sql()} AS words FROM {DOCS}),
 sets AS (SELECT DISTINCT id, array_to_string(words[i:i + 4], ' ') AS s
   FROM (SELECT id, words, unnest(range(1, len(words) - 3)) AS i FROM w WHERE len(words) >= 5 AND id = node)),
 n AS (SELECT id, count(*) AS n FROM sets GROUP BY id),
 common AS (SELECT x.id AS a, y.id AS b, count(*) AS c FROM sets x JOIN sets y ON x.s = y.s AND x.id < y.id GROUP BY x.id, y.id),
 scored AS (SELECT a, b, c::DOUBLE / (na.n + nb.n - c)::DOUBLE AS jaccard FROM common JOIN n na ON na.id = a JOIN n nb ON nb.id = b)
 SELECT a, b, jaccard, false AS copy FROM scored WHERE jaccard >= 0.8::DOUBLE
 UNION ALL SELECT node, id, 1.0::DOUBLE, true FROM w WHERE id <> node""",
)
def near_dup_pairs_exact(spark, sf):
    return near_dup_pairs(docs(spark, sf))


@query(
    "inject_duplicates",
    f"SELECT id, source, text FROM {DOCS} UNION ALL SELECT id, source, text FROM {DOCS} WHERE ((id + 1) * 7919) % 100 < 5",
)
def inject_duplicates(spark, sf):
    return dedup.inject_duplicates(docs(spark, sf).select("id", "source", "text"))


def verdicts(done, *columns):
    return done.kept.select(*columns, F.lit("kept").alias("verdict")).unionByName(
        done.removed.select(*columns, F.col("filter_reason").alias("verdict"))
    )


@query("deduplication", verdict_ctes() + " SELECT id, verdict FROM why")
def deduplication_(spark, sf):
    return verdicts(deduplication(docs(spark, sf), bit_precision=32), "id")


@query(
    "deduplication_injected",
    verdict_ctes() + " SELECT id, verdict FROM why UNION ALL SELECT id, 'exact' FROM why WHERE ((id + 1) * 7919) % 100 < 5",
)
def deduplication_injected(spark, sf):
    """Injected copies share the ids of their originals, and all of them go."""
    return verdicts(deduplication(dedup.inject_duplicates(busy_docs(spark, sf)), bit_precision=32), "id")


# Parts of one document share its id; here SQL gives each an id of its own, in the same order.
CHUNKS = f"""(SELECT id * 1000000 + i - 1 AS id, substring(text, (i - 1) * 700 + 1, 700) AS text
   FROM (SELECT *, unnest(range(1, ceil(length(text) / 700)::BIGINT + 1)) AS i FROM {DOCS}))"""


@query(
    "deduplication_chunks",
    verdict_ctes(CHUNKS) + " SELECT id // 1000000 AS id, (id % 1000000)::INTEGER AS chunk_idx, verdict FROM why",
)
def deduplication_chunks(spark, sf):
    """Parts of 700 characters, many to an id, are told apart."""
    parts = chunk_text(busy_docs(spark, sf).select("id", "text"), 700)
    return verdicts(deduplication(parts, bit_precision=32), "id", "chunk_idx")
