"""A Merkle manifest of a table: leaves, roots and proofs by rolling up nested structs.

Rows are ranked within their group, and the digits of a rank to the base of the fan-out say where its leaf hangs. Within a block of
``FANOUT ** LEVELS`` leaves the digits are grouped away one after the other, the last first: each step nests the structs of
one run of nodes in the struct of their parent. All steps share the exchange by block. A block is then one row that holds its part of the
tree, of bounded size, whatever the number of rows. The roots of blocks are leaves of further blocks, and the
roots of groups those of a last tree, by the same steps.

A block gets the path above it from a table with one row per block. After that nested transforms over the block's own struct and one explode
emit the proof of every leaf; no row of a leaf is ever joined.

Ranks need no sort of a whole group: rows are dealt by ranges of (group, order, leaf), numbered within their range, and
a row per group and range gives where each range begins.

Defined results: a null field is written ``-``, so it differs from an empty one; a null group is a group, before all others, and a null
order value comes before all others; rows of equal order are ordered by their leaf; repeated rows are leaves of their own; a group of
one row has its leaf as root; an empty table gives no row; texts of any length are hashed whole; columns other than those named are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendframe.llm.common import stored

#: Children of a node, and levels of the tree that one row holds: 4,096 leaves.
FANOUT, LEVELS = 8, 4
#: The fields of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(fields: Sequence[Column]) -> Column:
    """SHA-256 of the fields, each with its length in bytes before it, or ``-`` if null."""
    said = []
    for field in fields:
        value = field.cast("string")
        said.append(F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)))
    return F.sha2(F.concat(*said), 256)


def _ranked(rows: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``rows`` with their ``rank`` within ``group`` by ``order``, and the group's ``total``."""
    position = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    along = rows.repartitionByRange("group", *order).sortWithinPartitions("group", *order)
    placed = stored(along.withColumns({"range": F.spark_partition_id(), "position": position}), name)
    # A row per group and range: as many as there are ranges, and one more for each further group.
    sizes = placed.groupBy("group", "range").agg(F.min("position").alias("first"), F.count(F.lit(1)).alias("n"))
    ranges = Window.partitionBy("group").orderBy("range")
    before = F.coalesce(F.sum("n").over(ranges.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = F.sum("n").over(Window.partitionBy("group"))
    shifts = sizes.select("group", "range", (before - F.col("first")).alias("shift"), total.alias("total"))
    ranked = placed.join(shifts, ["group", "range"]).withColumn("rank", F.col("position") + F.col("shift"))
    return ranked.drop("range", "position", "shift")


def roll_up(nodes: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """(group, total, block, tree) from nodes (group, rank, total, hash): one row per block, its nodes nested in ``tree``.

    ``carried`` columns stay with the leaves of the tree. A level that the group's tree no longer has hands its only
    node on as it is.
    """
    digit = lambda level: F.pmod(F.floor(F.col("rank") / FANOUT**level), F.lit(FANOUT)).cast("int")
    digits = {f"digit_{level}": digit(level) for level in range(1, LEVELS)}
    leaf = F.struct(digit(0).alias("at"), "hash", *carried)
    df = (
        nodes.select("group", "total", F.floor(F.col("rank") / FANOUT**LEVELS).alias("block"), *(c.alias(n) for n, c in digits.items()), leaf.alias("node"))
        .repartition("group", "block")
    )
    left = list(digits)
    for level in range(LEVELS):
        df = df.groupBy("group", "total", "block", *left).agg(F.sort_array(F.collect_list("node")).alias("children"))
        joined = F.sha2(F.array_join("children.hash", ""), 256)
        value = F.when(F.col("total") > FANOUT**level, joined).otherwise(F.get("children.hash", F.lit(0)))
        at = F.col(left[0]) if left else F.lit(0)
        left = left[1:]
        # Digits are grouped away from the last one on, so the next one is the place of this node.
        df = df.select("group", "total", "block", *left, F.struct(at.alias("at"), value.alias("hash"), "children").alias("node"))
    return df.withColumnRenamed("node", "tree")


def emit(blocks: DataFrame, carried: Sequence[str] = (), above: Column | None = None) -> DataFrame:
    """Rows of ``roll_up``, unnested again: the columns of ``blocks`` but ``tree``, and for each leaf its place, ``hash``, ``carried``, ``path``.

    ``path`` has the hashes to the ``left`` and ``right`` of the leaf, and of each node above it, upwards; ``above`` is what
    it goes on with beyond the block.
    """

    def unnest(children: Column, level: int, upper: list[Column]) -> Column:
        def each(node: Column) -> Column:
            siblings = lambda keep: F.array_join(F.transform(F.filter(children, keep), lambda x: x["hash"]), "")
            beside = F.struct(
                siblings(lambda x: x["at"] < node["at"]).alias("left"), siblings(lambda x: x["at"] > node["at"]).alias("right")
            )
            path = [F.when(F.col("total") > FANOUT**level, beside), *upper]
            if level:
                return unnest(node["children"], level - 1, path)
            return F.struct(node["hash"].alias("hash"), *(node[c].alias(c) for c in carried), F.array_compact(F.array(*path)).alias("path"))

        rows = F.transform(children, each)
        return F.flatten(rows) if level else rows

    leaves = blocks.select("*", F.explode(unnest(F.col("tree.children"), LEVELS - 1, [])).alias("leaf")).drop("tree")
    path = F.col("leaf.path") if above is None else F.concat("leaf.path", above)
    return leaves.select(
        *(c for c in leaves.columns if c != "leaf"), "leaf.hash", *(F.col(f"leaf.{c}").alias(c) for c in carried), path.alias("path")
    )


def _roots(blocks: DataFrame) -> DataFrame:
    """The roots of blocks as nodes of the tree above."""
    total = F.ceil(F.col("total") / FANOUT**LEVELS)
    return blocks.select("group", F.col("block").alias("rank"), total.alias("total"), F.col("tree.hash").alias("hash"))


def climb(nodes: DataFrame) -> DataFrame:
    """(group, rank, path, top) from stored nodes (group, rank, total, hash): the path of each to the top of its group."""
    tiers: list[DataFrame] = []
    while (nodes.agg(F.max("total")).first()[0] or 0) > 1:
        blocks = stored(roll_up(nodes, ["rank"]), "nodes")
        tiers.append(emit(blocks, ["rank"]).select("group", "rank", "block", "path"))
        nodes = _roots(blocks)
    nothing = F.array().cast("array<struct<left:string,right:string>>")
    paths = nodes.select("group", "rank", nothing.alias("path"), F.col("hash").alias("top"))
    for tier in reversed(tiers):
        upper = paths.select("group", F.col("rank").alias("block"), F.col("path").alias("upper"), "top")
        paths = tier.join(upper, ["group", "block"]).select("group", "rank", F.concat("path", "upper").alias("path"), "top")
    return paths


def manifest(docs: DataFrame, claimed: dict[str, Column] | None = None) -> DataFrame:
    """(doc_id, leaf, claimed_leaf, subroot, root, path): a leaf per row of ``docs``, a subroot per ``lang``, ordered by ``doc_id``.

    ``claimed`` has other values of fields, as a reader may present them: ``claimed_leaf`` is their leaf, all else is of the true ones.
    """
    fields = [F.col(f) for f in FIELDS]
    other = [(claimed or {}).get(f, F.col(f)) for f in FIELDS]
    same = F.lit(True)
    for field, value in zip(fields, other, strict=True):
        same = same & field.eqNullSafe(value) if value is not field else same
    group = F.when(F.col("lang").isNull(), "0").otherwise(F.concat(F.lit("1"), F.col("lang").cast("string")))
    leaves = docs.select(
        group.alias("group"), F.col("doc_id").cast("long").alias("doc_id"), digest(fields).alias("hash"),
        F.when(~same, digest(other)).alias("claimed"), F.monotonically_increasing_id().alias("row"),
    )
    # Stored before they are dealt by ranges, which reads them twice: texts are hashed once.
    ranked = _ranked(stored(leaves, "leaves"), ["doc_id", "hash", "row"], "ordered-leaves").drop("row")
    carried = ["doc_id", "claimed"]
    blocks = stored(roll_up(ranked, carried), "blocks")
    groups = stored(climb(_roots(blocks)), "group-paths")
    tops = groups.filter("rank = 0").select(F.lit("").alias("group"), F.col("group").alias("name"), F.col("top").alias("hash"))
    ordered = _ranked(tops, ["name"], "ordered-groups")
    whole = ordered.join(
        climb(ordered.drop("name")).withColumnRenamed("top", "root"), ["group", "rank"]
    ).select(F.col("name").alias("group"), F.col("path").alias("to_root"), "root")
    above = groups.join(whole, "group").select(
        "group", F.col("rank").alias("block"), F.concat("path", "to_root").alias("above"), F.col("top").alias("subroot"), "root"
    )
    found = emit(blocks.join(above, ["group", "block"]), carried, F.col("above"))
    return found.select(
        "doc_id", F.col("hash").alias("leaf"), F.coalesce("claimed", "hash").alias("claimed_leaf"), "subroot", "root", "path"
    )


def fold(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` and the siblings along ``path`` give."""
    return F.aggregate(path, leaf, lambda below, p: F.sha2(F.concat(p["left"], below, p["right"]), 256))


def proof(path: Column) -> Column:
    """All siblings along ``path``, upwards and left to right, in one digest."""
    return F.sha2(F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), ""), 256)


def verify(found: DataFrame) -> DataFrame:
    """Rows of ``manifest`` with the digest of their proof, the root their claimed leaf folds to, and whether that is the root."""
    folded = found.withColumns({"proof_sha256": proof(F.col("path")), "folded_root": fold(F.col("claimed_leaf"), F.col("path"))})
    return folded.withColumn("verified", F.col("folded_root") == F.col("root")).drop("path", "claimed_leaf")
