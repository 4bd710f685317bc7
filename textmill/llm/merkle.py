"""Merkle manifest of a dataset with checkpointed levels.

Every document is a leaf; the leaves of a source form a ternary tree by id, and
the trees' roots form one more tree by source. Only every ``STRIDE``-th level is
written, as aligned subtrees: one row holds the up to 27 stored descendants of a
node STRIDE levels above them. A proof needs the levels in between as well. They
are computed anew inside the row from the stored descendants, give their
siblings and are dropped. Proofs go from the top down: the path above a subtree
is joined to it once, not once per leaf.

Places of leaves come from sorted ranges and one offset per range and source, so
a source with a third of all rows is spread like any other. Texts never travel.

Defined results
    null fields count as ``-``, empty texts as ``0:``; very long texts are hashed whole.
    null ids and the null source come first in their orders.
    Repeated ids are ordered by leaf; equal rows are leaves of their own.
    Empty table: no leaves, no root, no proofs.
    Other columns are ignored, whatever their names, unless carried.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from textmill.functions.arrays import let
from textmill.llm.rows import ranked
from textmill.session import materialize

FAN = 3
STRIDE = 3
SPAN = FAN**STRIDE
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
PATH = "array<struct<left:string,right:string>>"


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*[field(f) for f in fields]), 256)


def tree_name(source: Column) -> Column:
    """A name that is never null and sorts like the source, null first."""
    return F.coalesce(F.concat(F.lit("."), source.cast("string")), F.lit(""))


# Levels inside a stored subtree ------------------------------------------------


def folded(nodes: Column) -> Column:
    """The next level: a digest for every FAN consecutive nodes."""

    def above(below: Column) -> Column:
        runs = F.sequence(F.lit(1), F.size(below), F.lit(FAN))
        return F.transform(runs, lambda i: F.sha2(F.array_join(F.slice(below, i, FAN), ""), 256))

    return let(nodes, above)


def with_levels(blocks: DataFrame) -> DataFrame:
    """Add _level0 ... _level3, computed from the stored nodes.

    A subtree that is not alone in its level is folded STRIDE times. One that
    is alone is folded until one node remains; later levels repeat it.
    """
    out = blocks.withColumn("_level0", F.col("nodes"))
    for k in range(STRIDE):
        goes_on = (F.col("_size") > SPAN) | (F.size(f"_level{k}") > 1)
        out = out.withColumn(f"_level{k + 1}", F.when(goes_on, folded(F.col(f"_level{k}"))).otherwise(F.col(f"_level{k}")))
    return out


def tops(blocks: DataFrame) -> DataFrame:
    """(tree, block, _size, digest): the node above each subtree."""
    return with_levels(blocks).select("tree", "block", "_size", F.col(f"_level{STRIDE}")[0].alias("digest"))


def inner_path(place: Column) -> Column:
    """Siblings of the subtree's node at ``place`` (from 0), level by level."""
    steps = []
    for k in range(STRIDE):
        nodes, at = F.col(f"_level{k}"), F.floor(place / FAN**k).cast("int")
        first = at - at % FAN
        step = F.struct(
            F.array_join(F.slice(nodes, first + 1, at % FAN), "").alias("left"),
            F.array_join(F.slice(nodes, at + 2, FAN - 1 - at % FAN), "").alias("right"),
        )
        steps.append(F.when((F.col("_size") > SPAN) | (F.size(nodes) > 1), step))
    return F.filter(F.array(*steps), lambda s: s.isNotNull())


# Building --------------------------------------------------------------------


@dataclass(frozen=True)
class Manifest:
    """Stored levels: of the sources' trees from the leaves up, and of the tree above them."""

    sources: list[DataFrame]
    above: list[DataFrame]

    @property
    def root(self) -> DataFrame:
        """One row with the root; none for an empty table."""
        return tops(self.above[-1]).where(F.col("_size") <= SPAN).select(F.col("digest").alias("root"))


def subtrees(level: DataFrame, carried: list[str], label: str) -> DataFrame:
    """One row per SPAN consecutive nodes of a level, written."""
    member = F.struct("_pos", "digest", *carried)
    grouped = level.groupBy("tree", F.floor(F.col("_pos") / SPAN).alias("block")).agg(
        F.max("_size").alias("_size"), F.sort_array(F.collect_list(member)).alias("members")
    )
    nodes = grouped.withColumn("nodes", F.col("members.digest"))
    return materialize(nodes if carried else nodes.drop("members"), label)


def stored_levels(level: DataFrame, carried: list[str], label: str) -> list[DataFrame]:
    """Subtrees of the nodes (tree, _pos, _size, digest), of the nodes above them, and so on."""
    levels = [subtrees(level, carried, label)]
    most = levels[0].agg(F.max("_size")).first()[0] or 0
    while most > SPAN:
        # Trees that have come to one node leave here.
        higher = tops(levels[-1].where(F.col("_size") > SPAN)).select(
            "tree", F.col("block").alias("_pos"), F.ceil(F.col("_size") / SPAN).alias("_size"), "digest"
        )
        levels.append(subtrees(higher, [], label))
        most = -(-most // SPAN)
    return levels


def subroots(levels: list[DataFrame]) -> DataFrame:
    """(tree, digest) of every tree."""
    done = [tops(level.where(F.col("_size") <= SPAN)).select("tree", "digest") for level in levels]
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out


def build_manifest(
    docs: DataFrame, fields: list[str] | None = None, id_col: str = "doc_id", source: str = "source",
    carry: dict[str, Column] | None = None,
) -> Manifest:
    """Hash all rows and store every STRIDE-th level.

    ``carry`` names further columns of ``docs`` to store beside each leaf; proofs return them.
    """
    carry = carry or {}
    leaves = docs.select(
        tree_name(F.col(source)).alias("tree"), F.col(id_col).alias("_id"),
        leaf_digest([F.col(f) for f in fields or FIELDS]).alias("digest"),
        F.struct(F.lit(0).alias("_"), *[c.alias(name) for name, c in carry.items()]).alias("carried"),
        F.monotonically_increasing_id().alias("_row"),
    )
    placed = ranked(materialize(leaves, "leaves"), ["tree"], ["_id", "digest", "_row"], "ordered")
    levels = stored_levels(placed, ["_id", "carried"], "leaf-subtrees")
    roots = materialize(subroots(levels), "subroots")
    named = ranked(roots.withColumn("_forest", F.lit("")), ["_forest"], ["tree"], "sources")
    above = named.select(F.col("_forest").alias("tree"), F.col("tree").alias("name"), "_pos", "_size", "digest")
    return Manifest(levels, stored_levels(above, ["name"], "source-subtrees"))


# Proofs ----------------------------------------------------------------------


def leaf_paths(blocks: DataFrame, passed: list[str], member: str) -> DataFrame:
    """A row per stored node of subtrees that know ``upper``, the path above their top.

    ``member`` names what is exploded: the digests or, in the lowest level, the members.
    """
    keep = ["tree", "block", *[f"_level{k}" for k in range(STRIDE)], "_size", "upper", *passed]
    places = with_levels(blocks).select(*keep, F.posexplode(member).alias("_i", "member"))
    return places.select(
        "tree", (F.col("block") * SPAN + F.col("_i")).alias("block"), "member", *passed,
        F.concat(inner_path(F.col("_i")), F.col("upper")).alias("path"),
    )


def paths_down(levels: list[DataFrame], start: DataFrame, passed: list[str]) -> DataFrame:
    """Lowest stored nodes with the path from each to the root.

    ``start`` (tree, upper, ...) gives the path from each tree's own root on, and columns to pass down.
    """
    nodes = None
    for k in range(len(levels) - 1, -1, -1):
        here = levels[k].where(F.col("_size") <= SPAN).join(start, "tree")
        if nodes is not None:
            lower = nodes.select("tree", "block", F.col("path").alias("upper"), *passed)
            here = here.unionByName(levels[k].where(F.col("_size") > SPAN).join(lower, ["tree", "block"]))
        nodes = leaf_paths(here, passed, "members" if k == 0 else "nodes")
        if k:
            nodes = materialize(nodes.drop("member"), "paths")
    return nodes


def opened(levels: list[DataFrame], ids: DataFrame) -> list[DataFrame]:
    """The subtrees on the way to leaves with the given ids (_id)."""
    found = levels[0].select("tree", "block", F.explode("members._id").alias("_id")).join(ids, "_id", "left_semi")
    needed = materialize(found.select("tree", "block").distinct(), "opened")
    out = []
    for k, level in enumerate(levels):
        block = F.floor(F.col("block") / SPAN**k).alias("block")
        out.append(level.join(needed.select("tree", block).distinct(), ["tree", "block"], "left_semi"))
    return out


def extract_proofs(manifest: Manifest, wanted: DataFrame | None = None) -> DataFrame:
    """(tree, id, leaf, subroot, root, path, carried) of all leaves, or of those whose id is in ``wanted`` (one column).

    Subtrees without a wanted leaf are not opened.
    """
    whole = tops(manifest.above[-1].where(F.col("_size") <= SPAN))
    whole = whole.select("tree", F.array().cast(PATH).alias("upper"), F.col("digest").alias("root"))
    named = paths_down(manifest.above, whole, ["root"])
    trees = named.select(
        F.col("member.name").alias("tree"), F.col("path").alias("upper"), F.col("member.digest").alias("subroot"), "root"
    )
    levels, trees = manifest.sources, materialize(trees, "trees")
    if wanted is not None:
        ids = wanted.select(F.col(wanted.columns[0]).alias("_id")).distinct()
        levels = opened(levels, ids)
    leaves = paths_down(levels, trees, ["subroot", "root"]).select(
        "tree", F.col("member._id").alias("_id"), F.col("member.digest").alias("leaf"),
        "subroot", "root", "path", F.col("member.carried").alias("carried"),
    )
    if wanted is not None:
        leaves = leaves.join(ids, "_id", "left_semi")
    return leaves.withColumnRenamed("_id", "id")


def proof_digest(path: Column) -> Column:
    """The digest of all siblings in order."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def tampered_proofs(docs: DataFrame, tampered: Column, text: str = "text") -> DataFrame:
    """Proofs of all documents, folded from the leaves of texts changed to ``tampered`` where that is not null."""
    changed = leaf_digest([tampered if f == text else F.col(f) for f in FIELDS])
    manifest = build_manifest(docs, carry={"tampered": F.when(tampered.isNotNull(), changed)})
    proofs = extract_proofs(manifest).withColumn("_leaf", F.coalesce("carried.tampered", "leaf"))
    return proofs.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
        fold(F.col("_leaf"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
