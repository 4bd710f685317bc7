"""Secret scans with an incremental ledger of content-addressed blobs.

Every version of every path is named by the SHA-256 of its text. The ledger
holds one row per blob and rule version that has been scanned, with the spans
found. A scan looks only at blobs whose pair is not in the ledger, once per
blob however many paths share it, and findings are joined back to all paths.
Only DataFrame functions are used. What travels are digests and addresses; texts
are scanned where they lie (those of inputs that are no file scan move once).

Defined results
    null text: the empty text; empty text: no spans, and still a ledger row.
    Repeated rows, equal texts: scanned once, reported for every row.
    Failing matches (too short) are dropped after matching, so they still use
    up their characters. Offsets are code points, end exclusive.
    Extra columns stay; columns named like an output are replaced.
    Very long texts are scanned whole. Empty table: an empty ledger, no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from textmill.llm.rows import left_lookup, whole_text
from textmill.operators.addresses import address, is_scan, split_by_bitmap
from textmill.session import materialize, shared_dir

SPANS = "array<struct<start:int,rank:int,kind:string,end:int>>"
LEDGER_SCHEMA = f"blob string, rule_version string, spans {SPANS}"


@dataclass(frozen=True)
class SecretRule:
    """``pattern`` finds candidates; those with fewer than ``shortest`` characters in ``group`` are dropped.

    ``gate`` is a cheap search that every match implies.
    """

    kind: str
    pattern: str
    group: int
    shortest: int
    gate: str


# The three base rules. A run of 16 or more hex digits (18 or more after AKIA)
# is exactly a maximal run of that length, so the bound stands in the pattern.
_ASSIGN = "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
BASE_RULES = [
    SecretRule("assign", _ASSIGN, 2, 12, "(?i:password|passwd|secret|token|api_?key)"),
    SecretRule("access", "AKIA[A-Z0-9]{14,}", 0, 18, "AKIA"),
    SecretRule("hex", "[0-9a-f]{16,}", 0, 16, "[0-9a-f]{16}"),
]


def rule_version(rules: list[SecretRule]) -> str:
    """Names what a scan looks for; another rule set makes every blob unseen."""
    from hashlib import sha256

    return sha256(repr([(r.kind, r.pattern, r.group, r.shortest) for r in rules]).encode()).hexdigest()[:16]


def _spans(text: Column, rule: SecretRule, rank: int) -> Column:
    """Spans of the surviving matches; positions come from the pieces between matches."""
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    part = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else whole
    gaps = F.transform(F.split(text, rule.pattern, -1), lambda x: F.length(x))
    sizes = F.transform(whole, lambda x: F.length(x))
    # Walk once over (gap, match) pairs, carrying the position.
    walk = F.aggregate(
        F.arrays_zip(gaps.alias("g"), sizes.alias("s"), F.transform(part, lambda x: F.length(x)).alias("p")),
        F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("out")),
        lambda acc, x: F.struct(
            (acc["at"] + x["g"] + F.coalesce(x["s"], F.lit(0))).alias("at"),
            F.when(
                x["p"] >= rule.shortest,
                F.concat(
                    acc["out"],
                    F.array(
                        F.struct(
                            (acc["at"] + x["g"]).alias("start"),
                            F.lit(rank).alias("rank"),
                            F.lit(rule.kind).alias("kind"),
                            (acc["at"] + x["g"] + x["s"]).alias("end"),
                        )
                    ),
                ),
            ).otherwise(acc["out"]).alias("out"),
        ),
        lambda acc: acc["out"],
    )
    return F.when(text.rlike(rule.gate), walk).otherwise(F.array().cast(SPANS))


def find_spans(text: Column, rules: list[SecretRule]) -> Column:
    """All spans of a text by start, then rule order."""
    return F.array_sort(F.concat(*[_spans(text, r, i) for i, r in enumerate(rules)]))


def content_address(versions: DataFrame, text: str = "text") -> DataFrame:
    """Add blob, the SHA-256 of the text."""
    return versions.withColumn("blob", F.sha2(whole_text(text), 256))


def empty_ledger(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LEDGER_SCHEMA)


def scan_unseen(
    versions: DataFrame,
    ledger: DataFrame | None = None,
    rules: list[SecretRule] = BASE_RULES,
    path: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Ledger rows for the blobs of ``versions`` that the ledger does not hold under these rules.

    Digests choose one row of every unseen blob. In a file scan that row is known
    by its address: the texts are read once more and scanned where they lie, and
    only digests travel. Texts of other inputs move once, by blob and path.
    """
    version = rule_version(rules)
    spark = versions.sparkSession
    rows = versions.select(F.col(path).alias("_path"), F.col(text).alias("_text"))
    in_place = is_scan(rows)
    rows = rows.withColumn("_path", address()) if in_place else rows
    named = content_address(rows, "_text")
    one_path = named.groupBy("blob").agg(F.min("_path").alias("_path"))
    if ledger is not None:
        seen = ledger.where(F.col("rule_version") == version).select("blob").distinct()
        one_path = one_path.join(seen, "blob", "left_anti")
    wanted = materialize(one_path, "unseen")
    if in_place:
        _, fetched = split_by_bitmap(rows, wanted.select("_path"), "_path")
        once = content_address(fetched, "_text").select("blob", find_spans(whole_text("_text"), rules).alias("spans"))
    else:
        wanted = wanted.select(F.col("blob").alias("_blob"), F.col("_path").alias("_first"))
        fetched = named.join(wanted, (F.col("blob") == F.col("_blob")) & F.col("_path").eqNullSafe(F.col("_first")), "left_semi")
        # A path may hold one text several times; nothing is scanned twice for the ledger's sake.
        scanned = fetched.select("blob", find_spans(whole_text("_text"), rules).alias("spans"))
        once = scanned.groupBy("blob").agg(F.max("spans").alias("spans"))
    return spark.createDataFrame([], LEDGER_SCHEMA).unionByName(once.withColumn("rule_version", F.lit(version)))


def update_ledger(
    versions: DataFrame,
    ledger_path: str | None = None,
    rules: list[SecretRule] = BASE_RULES,
    path: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Append what is unseen to the ledger at ``ledger_path`` and return the whole ledger.

    Without a path the ledger starts empty in the shared folder. Appending is
    repeatable: a second call finds nothing unseen.
    """
    import uuid

    spark = versions.sparkSession
    ledger = None
    if ledger_path is None:
        ledger_path = f"{shared_dir(spark)}/textmill-ledger-{uuid.uuid4().hex}"
    else:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(ledger_path)
        if folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(folder):
            ledger = spark.read.schema(LEDGER_SCHEMA).parquet(ledger_path)
    scan_unseen(versions, ledger, rules, path, text).write.mode("append").parquet(ledger_path)
    return spark.read.schema(LEDGER_SCHEMA).parquet(ledger_path)


def findings(
    versions: DataFrame,
    ledger: DataFrame,
    rules: list[SecretRule] = BASE_RULES,
    path: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Every row of ``versions`` with blob and secret_spans, joined from the ledger by blob.

    Only blobs with findings are joined, in salted shares, so thousands of
    paths with one blob spread over many tasks.
    """
    named = content_address(versions.drop("blob", "secret_spans"), text)
    hits = (
        ledger.where((F.col("rule_version") == rule_version(rules)) & (F.size("spans") > 0))
        .groupBy("blob").agg(F.max("spans").alias("secret_spans"))
    )
    joined = left_lookup(named, hits, ["blob"], F.col(path))
    return joined.withColumn("secret_spans", F.coalesce("secret_spans", F.array().cast(SPANS)))


def span_string(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def redact(text: Column, spans: Column, marker: str = "[SECRET]") -> Column:
    """The text with every span replaced by a marker; overlapping spans share one."""
    cut = F.aggregate(
        spans,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")),
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(
                s["start"] >= acc["at"],
                F.concat(
                    acc["out"],
                    F.array(F.substr(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(marker)),
                ),
            ).otherwise(acc["out"]).alias("out"),
        ),
        lambda acc: F.concat(F.array_join(acc["out"], ""), F.substr(text, acc["at"] + 1, F.length(text))),
    )
    return F.when(F.size(spans) > 0, cut).otherwise(text)
