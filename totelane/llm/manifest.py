"""Operator 12: a Merkle manifest of a table, with proofs by nested intervals.

A row is a leaf: the hash of its fields, each with its length before it. Leaves of a group,
in ascending order, are ranked without a window over the group. Eight nodes side by side are
hashed to one, level by level, until one is left, the root of the group; the roots of all
groups make a tree of their own in the same way. A node carries the interval of leaf ranks it
covers. A node and the one above it are joined by containment: both are put in the bucket of
their level and place, and the interval of the one must lie within that of the other. The
siblings are what is left of the parent's children when those in the own interval are taken
away. From the root down each node adds its siblings to the path of its parent, so a leaf
meets one row, whatever the height of the tree, and no node meets all its leaves.

Null fields count as such and differ from empty ones. Rows without an id come first in their
group, rows with equal ids are in order of their hash; equal rows are leaves each for itself,
which of them is which makes no difference. A null group is a group, before all others. A
group of one row is its own root, as is a tree of one group. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from totelane.llm.common import hot_groups, meet
from totelane.operators.numbering import number_rows
from totelane.session import durable

FAN_OUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value with its number of bytes; a null is a dash."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


@dataclass(frozen=True)
class Manifest:
    """``leaves``: ``at``, ``id``, ``leaf``, ``changed``, ``tree``, ``size`` of the tree,
    ``low`` and ``high``, the rank. ``levels`` and ``top``: nodes of each level of the groups'
    trees and of the tree over their roots (``tree``, ``size``, ``low``, ``high``, ``digest``,
    from the second level on ``children``). ``trees``: ``tree``, ``label``, ``size``,
    ``subroot``. ``root`` is None where there are no rows."""

    leaves: DataFrame
    levels: list[DataFrame]
    trees: DataFrame
    top: list[DataFrame]
    root: str | None


def _levels(nodes: DataFrame, largest: int) -> list[DataFrame]:
    """All levels above ``nodes``; the largest tree has so many leaves. A tree ends with the
    level at which it has one node."""
    found, width = [nodes], 1
    while width < largest:
        bucket = F.floor(F.col("low") / F.lit(width * FAN_OUT))
        nodes = durable(
            nodes.filter(F.col("size") > width)
            .groupBy("tree", "size", bucket.alias("bucket"))
            .agg(F.array_sort(F.collect_list(F.struct("low", "high", "digest"))).alias("children"))
            .select(
                "tree",
                "size",
                F.col("children")[0]["low"].alias("low"),
                F.element_at("children", -1)["high"].alias("high"),
                F.sha2(F.array_join("children.digest", ""), 256).alias("digest"),
                "children",
            )
        )
        found.append(nodes)
        width *= FAN_OUT
    return found


def _ends(levels: list[DataFrame]) -> DataFrame:
    """The last node of each tree."""
    last = [
        nodes.filter(F.col("size") <= FAN_OUT**k).select("tree", F.col("digest").alias("subroot"))
        for k, nodes in enumerate(levels)
    ]
    return reduce(DataFrame.unionByName, last)


def _paths(levels: list[DataFrame]) -> DataFrame:
    """The lowest nodes with ``path``: per level the siblings to the left and to the right, as
    one text each, up to the last node of their tree."""
    none = F.array().cast(_PATH)
    found = levels[-1].withColumn("path", none)
    for k in range(len(levels) - 2, -1, -1):
        width = FAN_OUT ** (k + 1)
        own, above = F.col("low"), F.floor(F.col("low") / F.lit(width))
        parents = found.select(
            F.col("tree").alias("_tree"),
            above.alias("_bucket"),
            F.col("low").alias("_low"),
            F.col("high").alias("_high"),
            F.col("children").alias("_children"),
            F.col("path").alias("_path"),
        )
        within = (
            (F.col("tree") == F.col("_tree"))
            & (above == F.col("_bucket"))
            & (F.col("_low") <= own)
            & (F.col("high") <= F.col("_high"))
        )
        left = F.filter("_children", lambda x: x["high"] < F.col("low"))
        right = F.filter("_children", lambda x: x["low"] > F.col("high"))
        step = F.struct(
            F.array_join(F.transform(left, lambda x: x["digest"]), "").alias("left"),
            F.array_join(F.transform(right, lambda x: x["digest"]), "").alias("right"),
        )
        path = F.when(F.col("_path").isNull(), none).otherwise(F.concat(F.array(step), "_path"))
        # The last node of a tree has none above it.
        found = levels[k].join(parents, within, "left").select(*levels[k].columns, path.alias("path"))
    return found


def build_manifest(
    docs: DataFrame,
    fields: tuple[str, ...] = FIELDS,
    id_col: str = "doc_id",
    group_col: str = "lang",
    changed: Callable[[Column], Column] | None = None,
    text_col: str = "text",
    where: Column | None = None,
) -> Manifest:
    """The manifest of ``docs``. For checks, ``changed`` alters the text of the rows that
    ``where`` selects; ``leaves.changed`` is the hash of such a row, null for others."""
    values = {name: F.col(name) for name in fields}
    leaf = digest(*map(field, values.values()))
    other = F.lit(None).cast("string")
    if changed is not None:
        altered = values | {text_col: changed(F.col(text_col))}
        other = F.when(where, digest(*map(field, altered.values())))
    # A null group sorts before all others, even the empty one.
    label = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit("-"))
    rows = durable(
        docs.select(
            F.monotonically_increasing_id().alias("at"),
            F.col(id_col).alias("id"),
            label.alias("label"),
            leaf.alias("leaf"),
            other.alias("changed"),
        )
    )
    order = [F.col("label").asc(), F.col("id").asc_nulls_first(), F.col("leaf").asc(), F.col("at").asc()]
    ranked = number_rows(rows, order, "number")
    groups = durable(
        ranked.groupBy("label").agg(F.min("number").alias("start"), F.count(F.lit(1)).alias("size"))
    )
    trees = number_rows(groups, [F.col("label").asc()], "tree")
    found = groups.agg(F.count(F.lit(1)).alias("n"), F.max("size").alias("largest")).first()
    rank = F.col("number") - F.col("start")
    leaves = durable(
        meet(ranked, trees, "label", "inner", hot_groups(groups, "label", "size")).select(
            "at", "id", "leaf", "changed", "tree", "size", rank.alias("low"), rank.alias("high")
        )
    )
    levels = _levels(
        leaves.select("tree", "size", "low", "high", F.col("leaf").alias("digest")),
        found["largest"] or 0,
    )
    roots = durable(trees.join(_ends(levels), "tree").select("tree", "label", "size", "subroot"))
    place = F.col("tree") - 1
    top = _levels(
        roots.select(
            F.lit(0).cast("bigint").alias("tree"),
            F.lit(found["n"]).cast("bigint").alias("size"),
            place.alias("low"),
            place.alias("high"),
            F.col("subroot").alias("digest"),
        ),
        found["n"],
    )
    root = _ends(top).first()
    return Manifest(leaves, levels, roots, top, root["subroot"] if root else None)


def proofs(manifest: Manifest) -> DataFrame:
    """Each leaf with ``subroot``, ``root`` and ``path``, the siblings up to the root."""
    top = _paths(manifest.top).select((F.col("low") + 1).alias("tree"), F.col("path").alias("_above"))
    trees = durable(manifest.trees.join(top, "tree").select("tree", "size", "subroot", "_above"))
    inside = _paths([manifest.leaves, *manifest.levels[1:]])
    # A group of one row has nothing above its leaf but the tree over the groups.
    found = meet(inside.drop("size"), trees, "tree", "inner", hot_groups(trees, "tree", "size"))
    return found.select(
        "at",
        "id",
        "leaf",
        "changed",
        "subroot",
        F.lit(manifest.root).cast("string").alias("root"),
        F.concat("path", "_above").alias("path"),
    )


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path give."""
    return F.aggregate(path, leaf, lambda own, step: digest(step["left"], own, step["right"]))


def siblings(path: Column) -> Column:
    """All siblings of a path in one text."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), "")


def proof_report(manifest: Manifest) -> DataFrame:
    """``id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root``, ``verified``:
    whether the row as changed, or else as it is, still gives the root."""
    found = proofs(manifest).select(
        "id",
        "leaf",
        "subroot",
        "root",
        F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"),
        folded(F.coalesce("changed", "leaf"), F.col("path")).alias("folded_root"),
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
