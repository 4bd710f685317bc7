"""Document scans: folders, path lists, skip and limit, null and metadata handling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, NullType, StringType, StructField, StructType, VariantType

from textmill.operators.ordering import global_row_number


def read_documents(
    spark: SparkSession,
    path: str,
    glob: str = "*.parquet",
    recursive: bool = False,
    text_key: str = "text",
    id_key: str | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """Scan a folder of parquet. By default only its root, so logs below are skipped.

    What the glob names at the root may be a file or a table's folder, whose files need not match it.
    """
    whole = recursive or path.endswith(".parquet")
    reader = (
        spark.read.option("pathGlobFilter", glob if whole else f"{{{glob},*.parquet}}")
        .option("recursiveFileLookup", str(recursive).lower())
        .option("mergeSchema", "false")
    )
    if schema is not None:
        reader = reader.schema(schema)
    # A root-level glob keeps partition-like subfolders out of a flat scan.
    df = reader.parquet(path if whole else f"{path.rstrip('/')}/{glob}")
    if text_key != "text":
        df = df.withColumnRenamed(text_key, "text")
    return rename_id(df, id_key) if id_key else df


def read_paths_file(spark: SparkSession, paths_file: str, root: str = "") -> DataFrame:
    """Scan only the files named in a text file, one path per line."""
    names = [r[0].strip() for r in spark.read.text(paths_file).toLocalIterator()]
    paths = [n if n.startswith("/") or "://" in n else f"{root.rstrip('/')}/{n}" for n in names if n]
    if not paths:
        raise ValueError(f"{paths_file} names no file")
    return spark.read.parquet(*paths)


def scan_skip_limit(df: DataFrame, skip: int = 0, limit: int = -1, id_col: str = "id") -> DataFrame:
    """Rows skip+1 .. skip+limit in id order; limit -1 keeps all that follow.

    Only ids are ordered, to find the two ids between which the wanted rows lie;
    the rows themselves are filtered where they are. Rows with one id are taken
    or left together. Rows without an id are never taken.
    """
    if skip <= 0 and limit < 0:
        return df
    numbered = global_row_number(df.where(F.col(id_col).isNotNull()).groupBy(id_col).count(), [id_col], "_end", F.col("count"))
    wanted = F.col("_end") > skip
    if limit >= 0:
        wanted &= F.col("_end") <= skip + limit
    first, last = numbered.where(wanted).agg(F.min(id_col), F.max(id_col)).first()
    return df.where(F.col(id_col).between(first, last)) if first is not None else df.where(F.lit(False))


def rename_id(df: DataFrame, id_key: str) -> DataFrame:
    """Take the document id from the given column."""
    return df if id_key == "id" else df.drop("id").withColumnRenamed(id_key, "id")


def null_guard(df: DataFrame) -> DataFrame:
    """Ensure text and extra exist and are never null."""
    fixed = {}
    for name in ("text", "extra"):
        if name not in df.columns:
            fixed[name] = F.lit("")
        elif isinstance(df.schema[name].dataType, StringType):
            fixed[name] = F.coalesce(F.col(name), F.lit(""))
        else:
            fixed[name] = F.coalesce(F.to_json(name), F.lit(""))
    return df.withColumns(fixed)


def expand_metadata(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Turn the metadata column into top-level columns; metadata wins a name clash.

    A struct, a map, JSON text or a VARIANT, whose objects may differ from row to
    row. The keys of a map and the fields of objects are listed from the data
    unless ``keys`` names them: distinct keys are few, the rows are not. Fields
    of several types become text. Text that is no JSON object has no fields.
    """
    if "metadata" not in df.columns:
        return df
    kind = df.schema["metadata"].dataType
    if isinstance(kind, StructType):
        names = kind.fieldNames()
        values = {n: F.col(f"metadata.`{n}`") for n in names}
    elif isinstance(kind, MapType):
        if keys is None:
            found = df.select(F.explode(F.map_keys("metadata")).alias("k")).distinct().orderBy("k")
            keys = [r.k for r in found.limit(MAX_METADATA_KEYS + 1).collect()]
            if len(keys) > MAX_METADATA_KEYS:
                raise ValueError("too many metadata keys to become columns; pass keys")
        values = {n: F.try_element_at("metadata", F.lit(n)) for n in keys}
    elif isinstance(kind, (StringType, VariantType)):
        values = _variant_fields(df, kind, keys)
    else:
        raise TypeError(f"metadata is {kind.simpleString()}")
    kept = [F.col(f"`{c}`") for c in df.columns if c != "metadata" and c not in values]
    return df.select(*kept, *[v.alias(n) for n, v in values.items()])


def _variant_fields(df: DataFrame, kind: DataType, keys: list[str] | None) -> dict[str, Column]:
    """The fields of all objects; their common types come from one aggregate over the column."""
    value = F.col("metadata")
    if isinstance(kind, StringType):
        value = F.when(F.json_object_keys(value).isNotNull(), F.try_parse_json(value))
    else:
        value = F.when(F.schema_of_variant(value).startswith("OBJECT<"), value)
    found = df.agg(F.schema_of_variant_agg(value)).first()[0]
    fields = {}
    if found and found.startswith("OBJECT<"):
        described = StructType.fromDDL(found[len("OBJECT<") : -1].replace("OBJECT<", "STRUCT<"))
        if len(described) > MAX_METADATA_KEYS and keys is None:
            raise ValueError("too many metadata keys to become columns; pass keys")
        fields = {f.name: f.dataType for f in described if keys is None or f.name in keys}
    out = {}
    for name, type_ in fields.items():
        path = "$['{}']".format(name.replace("\\", "\\\\").replace("'", "\\'"))
        out[name] = F.try_variant_get(value, path, _settled(type_).simpleString())
    return out


def _settled(kind: DataType) -> DataType:
    """The type with text for what has no type of its own, or several."""
    if isinstance(kind, ArrayType):
        return ArrayType(_settled(kind.elementType))
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, _settled(f.dataType)) for f in kind])
    return StringType() if isinstance(kind, (VariantType, NullType)) else kind


MAX_METADATA_KEYS = 1000


def balance(df: DataFrame) -> DataFrame:
    """Deal rows out to all cores when the scan has fewer splits than there are cores.

    Never to fewer partitions than before: an input with a split for each core
    passes unchanged, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
