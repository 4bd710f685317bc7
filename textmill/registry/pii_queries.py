"""Personal data: detectors, overlap resolution, grouping, masking, summary."""

from pyspark.sql import functions as F

from textmill.functions.arrays import explode_once
from textmill.functions.fixed_values import PII_PRECEDENCE
from textmill.operators import pii
from textmill.operators.gazetteer import listed_entities
from textmill.registry.base import DOCS, ORACLES, busy_docs, docs, query, table
from textmill.sources.reader import balance

# The documents hold few kinds of personal data. Further ones are derived from
# each row's own id and counts, by the same rule in Spark and in SQL.
PLANT_SQL = """' Mail u' || (id % 7) || '@example.com, IBAN NL91ABNA0417164300 or NL92ABNA0417164300, site https://www.example.org/p/' || id
 || ' SSN 111222333 or ' || lpad(n_chars::VARCHAR, 9, '1') || ', card 4111 1111 1111 1111 exp 0' || (1 + id % 9) || '/2' || (id % 10)
 || ' cvv: ' || (100 + id % 900) || ', passport NW' || (10000 + id % 80000) || '7, driver licence 5' || lpad(id::VARCHAR, 9, '0')
 || ', polis ' || lpad(id::VARCHAR, 9, '8') || ' ref ' || lpad(n_chars::VARCHAR, 8, '3') || ', 1234 AB at 52.' || (1000 + id % 9000) || ', 4.8952 car GB-'
 || (100 + id % 900) || '-K tel 06-' || (10000000 + id) || ' ip 10.0.' || (id % 300) || '.1 mail u' || (id % 7) || '@example.com. '"""


def _plant(id_, n):
    def txt(c):
        return c.cast("string")

    parts = [
        " Mail u", txt(id_ % 7), "@example.com, IBAN NL91ABNA0417164300 or NL92ABNA0417164300, site https://www.example.org/p/", txt(id_),
        " SSN 111222333 or ", F.lpad(txt(n), 9, "1"), ", card 4111 1111 1111 1111 exp 0", txt(id_ % 9 + 1), "/2", txt(id_ % 10),
        " cvv: ", txt(id_ % 900 + 100), ", passport NW", txt(id_ % 80000 + 10000), "7, driver licence 5", F.lpad(txt(id_), 9, "0"),
        ", polis ", F.lpad(txt(id_), 9, "8"), " ref ", F.lpad(txt(n), 8, "3"), ", 1234 AB at 52.", txt(id_ % 9000 + 1000), ", 4.8952 car GB-",
        txt(id_ % 900 + 100), "-K tel 06-", txt(id_ + 10000000), " ip 10.0.", txt(id_ % 300), ".1 mail u", txt(id_ % 7), "@example.com. ",
    ]
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def planted(spark, sf):
    df = busy_docs(spark, sf)
    return df.withColumn("text", F.concat("text", _plant(F.col("id"), F.col("n_chars")), "text"))


SRC = f"(SELECT id, lang, text || {PLANT_SQL} || text AS text FROM {DOCS})"
CVV_RULE = "regexp_matches(entity, '^[0-9]{3}$')"

DIGITS = "list_transform(string_split(regexp_replace(entity, '[^0-9]', '', 'g'), ''), lambda c: c::INTEGER)"
LUHN = f"""len({DIGITS}) BETWEEN 13 AND 19 AND list_sum(list_transform(list_reverse({DIGITS}),
 lambda x, i: CASE WHEN i % 2 = 1 THEN x WHEN x > 4 THEN 2 * x - 9 ELSE 2 * x END)) % 10 = 0"""
ELEVEN_SUM = f"list_sum(list_transform({DIGITS}, lambda x, i: CASE WHEN i = 9 THEN -x ELSE x * (10 - i) END))"
ELEVEN = f"CASE WHEN regexp_matches(entity, '^[0-9]{{9}}$') THEN {ELEVEN_SUM} % 11 = 0 AND {ELEVEN_SUM} <> 0 ELSE false END"
IBAN = """CASE WHEN regexp_matches(entity, '^[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}$') THEN list_reduce(list_prepend(0,
 list_transform(string_split(substr(entity, 5) || substr(entity, 1, 4), ''), lambda c: ascii(c) - CASE WHEN regexp_matches(c, '[0-9]') THEN 48 ELSE 55 END)),
 lambda r, v: (CASE WHEN v > 9 THEN r * 100 + v ELSE r * 10 + v END) % 97) = 1 ELSE false END"""
OCTETS = "len(list_filter(string_split(entity, '.'), lambda x: length(x) > 3 OR x::INTEGER > 255)) = 0"
COORD = "abs(string_split(entity, ',')[1]::DOUBLE) <= 90 AND abs(trim(string_split(entity, ',')[2])::DOUBLE) <= 180"

# type, pattern, core, rule
SQL_DETECTORS = [
    ("EMAIL_ADDRESS", pii.EMAIL, None, "true"),
    ("IP_ADDRESS", pii.IP, None, OCTETS),
    ("PHONE_NUMBER", pii.PHONE, None, "true"),
    ("PHONE_NUMBER", pii.DASHED, None, "regexp_matches(entity, '^0[0-9]{1,3}-[0-9]{6,8}$')"),
    ("URL", pii.URL, None, "true"),
    ("BANK_ACCOUNT", pii.TOKEN, None, IBAN),
    ("CREDIT_CARD", pii.CARD, None, LUHN),
    ("CREDIT_CARD_EXPIRATION", pii.EXPIRATION, None, "regexp_matches(entity, '^(0[1-9]|1[0-2])/[0-9]{2}$')"),
    ("CVV", pii.CVV, "[0-9]+$", CVV_RULE),
    ("SSN", pii.TOKEN, None, ELEVEN),
    ("PASSPORT_NUMBER", pii.TOKEN, None, "regexp_matches(entity, '^[A-NP-Z]{2}[A-NP-Z0-9]{5}[0-9]$')"),
    ("DRIVER_LICENSE", pii.LICENSE, "[0-9]+$", "regexp_matches(entity, '^[0-9]{10}$')"),
    ("HEALTHCARE_NUMBER", pii.HEALTH, "[0-9]+$", "regexp_matches(entity, '^[0-9]{9}$')"),
    ("NUMERICAL_PII", pii.TOKEN, None, "regexp_matches(entity, '^[0-9]{8}$')"),
    ("LOCATION_ZIP", pii.ZIP, None, "regexp_matches(entity, '^[1-9][0-9]{3} ?[A-Z]{2}$')"),
    ("LOCATION_COORDINATE", pii.COORDINATE, None, COORD),
    ("VEHICLE_ID", pii.DASHED, None,
     f"regexp_matches(entity, '{pii.PLATE_SHAPE}') AND regexp_matches(entity, '[A-Z]') AND regexp_matches(entity, '[0-9]') AND length(entity) = 8"),
]


def _q(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def candidates_sql(types=None, source: str = SRC) -> str:
    """Body of a CTE c(id, s, e, type, entity)."""
    out = []
    for type_, pattern, core, rule in SQL_DETECTORS:
        if types is not None and type_ not in types:
            continue
        # RE2 never backtracks, so it has no possessive quantifiers.
        pattern = pattern.replace("++", "+").replace("*+", "*")
        entity = "m" if core is None else f"regexp_extract(m, {_q(core)})"
        out.append(f"""SELECT id, e - length(entity) AS s, e, '{type_}' AS type, entity FROM (
  SELECT id, e, {entity} AS entity FROM (
    SELECT id, f[k] AS m, sum(length(g[k]) + length(f[k])) OVER (PARTITION BY id ORDER BY k) AS e FROM (
      SELECT id, f, g, unnest(range(1, len(f) + 1)) AS k FROM (
        SELECT id, regexp_extract_all(text, {_q(pattern)}) AS f, string_split_regex(text, {_q(pattern)}) AS g FROM {source}) ) ) ) WHERE {rule}""")
    return " UNION ALL ".join(out)


RANK = "CASE type " + " ".join(f"WHEN '{t}' THEN {i}" for i, t in enumerate(PII_PRECEDENCE)) + " END"


def resolved_ctes(source: str = SRC, extra: str = "") -> str:
    return f"""WITH src AS (SELECT * FROM {source}), c AS ({candidates_sql(None, 'src')}{extra}),
 r AS (SELECT *, max(e) OVER (PARTITION BY id ORDER BY s, e, type, entity ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM c),
 i AS (SELECT *, sum(CASE WHEN reach IS NULL OR s >= reach THEN 1 ELSE 0 END) OVER (PARTITION BY id ORDER BY s, e, type, entity
   ROWS UNBOUNDED PRECEDING) AS isl FROM r),
 x AS (SELECT id, min(s) AS s, max(e) AS e, arg_min(type, (e - s) * -1000000000 + {RANK} * 10000000 + s) AS type FROM i GROUP BY id, isl),
 ent AS (SELECT x.id, s, e, type, substring(text, s::BIGINT + 1, (e - s)::BIGINT) AS entity FROM x JOIN src ON src.id = x.id)"""


def grouped_ctes(source: str = SRC, window: int = 4500) -> str:
    return resolved_ctes(source) + f""",
 lg AS (SELECT *, lag(e) OVER (PARTITION BY id, type, entity ORDER BY s) AS pe FROM ent),
 sess AS (SELECT *, sum(CASE WHEN pe IS NULL OR s - pe > {window} THEN 1 ELSE 0 END) OVER (PARTITION BY id, type, entity ORDER BY s) AS ss FROM lg),
 fst AS (SELECT *, min(s) OVER (PARTITION BY id, type, entity, ss) AS first FROM sess),
 grp AS (SELECT *, dense_rank() OVER (PARTITION BY id, type ORDER BY first) AS no FROM fst)"""


def flat(df, array: str, *fields: str):
    """One row per entity, so results are plain columns."""
    names = {"start": "start_index", "end": "end_index"}
    return explode_once(df, ["id"], F.col(array), "x").select(
        "id", *[F.col(f"x.{f}").alias(names.get(f, f)) for f in fields]
    )


def detector_query(key: str, types: list[str]):
    @query(
        key,
        f"SELECT id, s::INTEGER AS start_index, e::INTEGER AS end_index, type, entity FROM ({candidates_sql(types)})",
    )
    def run(spark, sf):
        df = planted(spark, sf).select("id", pii.detect(F.col("text"), types).alias("found"))
        return flat(df, "found", "start", "end", "type", "entity")


detector_query("detect_pii_email", ["EMAIL_ADDRESS"])
detector_query("detect_pii_ip", ["IP_ADDRESS"])
detector_query("detect_pii_phone", ["PHONE_NUMBER"])
detector_query("detect_pii_iban", ["BANK_ACCOUNT"])
detector_query("detect_pii_card", ["CREDIT_CARD", "CREDIT_CARD_EXPIRATION", "CVV"])
detector_query("detect_pii_ids", ["SSN", "PASSPORT_NUMBER", "DRIVER_LICENSE", "HEALTHCARE_NUMBER", "NUMERICAL_PII"])
detector_query("detect_pii_place", ["LOCATION_ZIP", "LOCATION_COORDINATE", "VEHICLE_ID"])


@query(
    "detect_pii_url",
    "SELECT id, s::INTEGER AS start_index, e::INTEGER AS end_index, type, entity FROM ("
    + candidates_sql(["URL"], "(SELECT page_id AS id, url || ' ' || html AS text FROM pages)") + ")",
)
def detect_pii_url(spark, sf):
    df = balance(table(spark, sf, "pages")).select(
        F.col("page_id").alias("id"), F.concat("url", F.lit(" "), "html").alias("text")
    )
    return flat(df.select("id", pii.detect(F.col("text"), ["URL"]).alias("found")), "found", "start", "end", "type", "entity")


TERMS_SQL = r"""(SELECT DISTINCT regexp_extract(text, '[\p{L}\p{N}_]+ [\p{L}\p{N}_]+') AS term, 'NAME' AS type FROM benchmark
 UNION SELECT DISTINCT regexp_extract(text, '[\p{L}\p{N}_]+'), 'NAME_GIVEN' FROM benchmark)"""


def terms_table(spark, sf):
    """A term list drawn from the benchmark table: leading words and word pairs."""
    bench = table(spark, sf, "benchmark")
    token = "[\\p{L}\\p{N}_]+"
    pair = F.regexp_extract("text", f"{token} {token}", 0)
    return bench.select(pair.alias("term"), F.lit("NAME").alias("type")).union(
        bench.select(F.regexp_extract("text", token, 0), F.lit("NAME_GIVEN"))
    ).distinct()


def gram_sql(n: int) -> str:
    cond = " AND ".join(f"g[k + {j}] = ' '" for j in range(1, n)) or "true"
    return f"""SELECT id, st[k] AS s, array_to_string(f[k:k + {n - 1}], ' ') AS term FROM (
     SELECT *, unnest(range(1, len(f) - {n - 1} + 1)) AS k FROM tok WHERE len(f) >= {n}) WHERE {cond}"""


@query(
    "detect_pii_gazetteer",
    rf"""WITH m AS (SELECT id, regexp_extract_all(text, '[\p{{L}}\p{{N}}_]+') AS f, string_split_regex(text, '[\p{{L}}\p{{N}}_]+') AS g FROM {DOCS}),
 k AS (SELECT id, f, g, unnest(range(1, len(f) + 1)) AS k FROM m),
 st AS (SELECT id, f, g, k, sum(length(g[k]) + length(f[k])) OVER (PARTITION BY id ORDER BY k) - length(f[k]) AS s FROM k),
 tok AS (SELECT id, any_value(f) AS f, any_value(g) AS g, list(s ORDER BY k) AS st FROM st GROUP BY id),
 r AS ({gram_sql(1)} UNION ALL {gram_sql(2)} UNION ALL {gram_sql(3)})
 SELECT id, s::INTEGER AS start_index, (s + length(term))::INTEGER AS end_index, type, term AS entity FROM r JOIN {TERMS_SQL} t USING (term)""",
)
def detect_pii_gazetteer(spark, sf):
    terms = terms_table(spark, sf).withColumn("public", F.lit(False))
    found = busy_docs(spark, sf).withColumn("listed", listed_entities(F.col("text"), terms))
    return flat(found, "listed", "start", "end", "type", "entity")


# Of every seventh document its first one to eight words, where one blank alone parts them.
LONG_TERM = r"^[\p{L}\p{N}_]+(?: [\p{L}\p{N}_]+){%d}"
LONG_TERMS_SQL = f"""(SELECT DISTINCT term, 'LOCATION_ADDRESS' AS type FROM (SELECT CASE id // 7 % 8
   {" ".join(f"WHEN {n} THEN regexp_extract(text, '{LONG_TERM % n}')" for n in range(8))} END AS term FROM {DOCS} WHERE id % 7 = 0) WHERE term <> '')"""


def long_terms(spark, sf):
    """A term list drawn from the documents: one to eight leading words."""
    cut = F.when(F.lit(False), F.lit(""))
    for n in range(8):
        cut = cut.when(F.floor(F.col("id") / 7) % 8 == n, F.regexp_extract("text", LONG_TERM % n, 0))
    heads = docs(spark, sf).where(F.col("id") % 7 == 0).select(cut.alias("term")).where("term <> ''").distinct()
    return heads.withColumns({"type": F.lit("LOCATION_ADDRESS"), "public": F.lit(False)})


@query(
    "detect_pii_gazetteer_long",
    rf"""WITH RECURSIVE m AS (SELECT id, regexp_extract_all(text, '[\p{{L}}\p{{N}}_]+') AS f, string_split_regex(text, '[\p{{L}}\p{{N}}_]+') AS g FROM {DOCS}),
 k AS (SELECT id, f, g, unnest(range(1, len(f) + 1)) AS k FROM m),
 st AS (SELECT id, f, g, k, sum(length(g[k]) + length(f[k])) OVER (PARTITION BY id ORDER BY k) - length(f[k]) AS s FROM k),
 tok AS (SELECT id, any_value(f) AS f, any_value(g) AS g, list(s ORDER BY k) AS st FROM st GROUP BY id),
 r AS ({" UNION ALL ".join(gram_sql(n) for n in range(1, 9))}),
 hit AS (SELECT id, s, max(s + length(term)) AS e, arg_max(term, length(term)) AS term FROM r JOIN {LONG_TERMS_SQL} t USING (term) GROUP BY id, s),
 pick AS (SELECT id, arg_min(hit, s) AS h FROM hit GROUP BY id
   UNION ALL SELECT p.id, arg_min(n, n.s) FROM pick p JOIN hit n ON n.id = p.id AND n.s >= p.h.e GROUP BY p.id, p.h.s)
 SELECT id, h.s::INTEGER AS start_index, h.e::INTEGER AS end_index, 'LOCATION_ADDRESS' AS type, h.term AS entity FROM pick""",
)
def detect_pii_gazetteer_long(spark, sf):
    """Leftmost longest matches of terms of up to eight words."""
    found = busy_docs(spark, sf).withColumn("listed", listed_entities(F.col("text"), long_terms(spark, sf), longest=True, shard_terms=20))
    return flat(found, "listed", "start", "end", "type", "entity")


@query("detect_pii_gazetteer_join", ORACLES["detect_pii_gazetteer"])
def detect_pii_gazetteer_join(spark, sf):
    """The way beyond the size bound: token runs joined with the term table."""
    terms = terms_table(spark, sf).withColumn("public", F.lit(False))
    found = pii.gazetteer_matches(busy_docs(spark, sf), terms)
    return flat(found, "entities", "start", "end", "type", "entity")


@query(
    "resolve_overlaps",
    resolved_ctes() + " SELECT id, s::INTEGER AS start_index, e::INTEGER AS end_index, type, entity FROM ent",
)
def resolve_overlaps(spark, sf):
    return flat(pii.with_entities(planted(spark, sf)), "entities", "start", "end", "type", "entity")


@query(
    "pii_public_figures",
    resolved_ctes(
        DOCS, f" UNION ALL SELECT id, s, s + length(term), 'NAME_GIVEN', term FROM (SELECT id, text, 0 AS s, 'The' AS term FROM src) WHERE regexp_matches(text, '^The[^\\p{{L}}\\p{{N}}_]') "
    ) + " SELECT id, s::INTEGER AS start_index, type, entity, type LIKE 'NAME%' AND entity = 'The' AS public FROM ent",
)
def pii_public_figures(spark, sf):
    """Documents that open with a listed first name: the name is found and stays public."""
    df = busy_docs(spark, sf)
    first = F.regexp_extract("text", "^The(?=[^\\p{L}\\p{N}_])", 0)
    name = F.array(F.struct(
        F.lit(0).alias("start"), F.length(first).alias("end"), F.lit("NAME_GIVEN").alias("type"),
        first.alias("entity"), F.lit(False).alias("public"),
    )).cast(pii.ENTITIES)
    found = F.concat(pii.detect(F.col("text")), F.filter(name, lambda e: e["entity"] != ""))
    df = df.withColumn("found", found).withColumn(
        "entities", pii.flag_public(pii.resolve_overlaps(F.col("found"), F.col("text")), ["The"])
    )
    return flat(df, "entities", "start", "type", "entity", "public")


@query(
    "entity_window",
    grouped_ctes(window=1000) + " SELECT id, s::INTEGER AS start_index, type, entity, no::INTEGER AS no FROM grp",
)
def entity_window(spark, sf):
    df = pii.with_entities(planted(spark, sf))
    return flat(
        df.withColumn("grouped", pii.group_entities(F.col("entities"), 1000)), "grouped", "start", "type", "entity", "no"
    )


MASKED_SQL = """, pc AS (SELECT *, coalesce(lag(e) OVER (PARTITION BY id ORDER BY s), 0) AS pv FROM grp),
 bits AS (SELECT p.id, s, substring(text, pv::BIGINT + 1, (s - pv)::BIGINT) || '[' || type || '_' || no || ']' AS bit FROM pc p JOIN src ON src.id = p.id),
 tail AS (SELECT id, max(e) AS e FROM grp GROUP BY id),
 body AS (SELECT id, string_agg(bit, '' ORDER BY s) AS body FROM bits GROUP BY id),
 masked AS (SELECT src.id, CASE WHEN body IS NULL THEN text ELSE body || substring(text, tail.e::BIGINT + 1) END AS text
   FROM src LEFT JOIN body ON body.id = src.id LEFT JOIN tail ON tail.id = src.id)"""


@query("mask_markers", grouped_ctes() + MASKED_SQL + " SELECT id, text FROM masked")
def mask_markers(spark, sf):
    return pii.mask_documents(planted(spark, sf), replacement_type="MARKER").select("id", "text")


@query("mask_synthetic")
def mask_synthetic(spark, sf):
    out = pii.mask_documents(planted(spark, sf), replacement_type="SYNTHETIC", synthetic_replacement_chance=0.9)
    return out.select("id", "text")


@query(
    "pii_summary",
    grouped_ctes() + """ SELECT src.id, coalesce(string_agg(DISTINCT type, ',' ORDER BY type), '') AS entity_types,
 count(type)::BIGINT AS n_processed, count(DISTINCT entity)::BIGINT AS n_entities
 FROM src LEFT JOIN grp ON grp.id = src.id GROUP BY src.id""",
)
def pii_summary(spark, sf):
    out = pii.mask_documents(planted(spark, sf), replacement_type="MARKER")
    return out.select(
        "id",
        F.array_join("PII.entity_types", ",").alias("entity_types"),
        F.aggregate("PII.entity_type_counts", F.lit(0).cast("long"), lambda a, x: a + x).alias("n_processed"),
        F.size("PII.processed_entities").cast("long").alias("n_entities"),
    )
