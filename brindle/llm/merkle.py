"""A Merkle manifest of a dataset: leaves by row, a tree per group, a tree over the groups' roots; every row gets its proof.

A leaf is the SHA-256 (lowercase hex) of the row's fields, each as ``-`` if null, else its number of UTF-8 bytes, ``:`` and its value. Inside a group leaves stand by id.
A level is one window: partitioned by group and parent (16 consecutive nodes), ordered, over the full frame. Its
``collect_list`` is the parent's preimage, and without the node itself its siblings. One row a parent goes on to the next level,
until one node is left. The groups' roots, by name, make the last tree in the same way.

Leaves are numbered by ranges of (group, id), so a group of any size is dealt to many tasks; texts are hashed where they are read and never exchanged. Proofs are put together from
the top down: a node's path is its own siblings, then its parent's path.

Cases: a null group is a group of its own, the first. A null id comes first. Rows with equal ids stand by their leaves; fully equal rows
have neighbouring places, which of them has which doesn't show. A lone leaf is its group's root, a lone group's root is the root; an empty list of siblings is hashed as the empty text.
An empty table gives an empty result. Columns that are no fields are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .runtime import configure, stage

FAN = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<before:string,after:string>>"


def part(value: Column) -> Column:
    """A field in a leaf's preimage."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(*values: Column) -> Column:
    return F.sha2(F.concat(*[part(v) for v in values]), 256)


def group_key(group: Column) -> Column:
    """A text that orders as the names do, byte by byte, and puts null first."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def placed(nodes: DataFrame, *order: str) -> DataFrame:
    """Adds i, the node's place in its group g (0 and up, by ``order``), and n, the group's size. A range of nodes is a task; only counts meet."""
    cut = nodes.repartitionByRange("g", *order).sortWithinPartitions("g", *order)
    cut = stage(cut.withColumn("_m", F.monotonically_increasing_id()), "places").withColumn("_p", F.shiftright("_m", 33))
    runs = cut.groupBy("g", "_p").agg(F.min("_m").alias("_first"), F.count("*").alias("_c"))
    of = Window.partitionBy("g")
    before = F.coalesce(F.sum("_c").over(of.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select("g", "_p", (before - F.col("_first")).alias("_off"), F.sum("_c").over(of).alias("n"))
    return cut.join(runs, ["g", "_p"]).withColumn("i", F.col("_m") + F.col("_off")).drop("_m", "_p", "_off")


def level(nodes: DataFrame) -> DataFrame:
    """nodes: (g, i, n, h, ...) of groups with several nodes. Adds the parent's place ``up``, its hash ``over``, and the siblings before and after a node."""
    w = Window.partitionBy("g", "up").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    at = (F.col("i") % FAN).cast("int")
    run = nodes.withColumn("up", F.expr(f"i div {FAN}")).withColumn("_run", F.collect_list("h").over(w))  # FAN hashes at most
    join = lambda first, length: F.array_join(F.slice("_run", first, length), "")
    return run.withColumn("over", F.sha2(F.array_join("_run", ""), 256)).withColumn("before", join(F.lit(1), at)).withColumn("after", join(at + 2, F.lit(FAN))).drop("_run")


def parents(nodes: DataFrame) -> DataFrame:
    """One row a parent."""
    return nodes.where(F.col("i") % FAN == 0).select("g", F.col("up").alias("i"), F.expr(f"(n + {FAN - 1}) div {FAN}").alias("n"), F.col("over").alias("h"))


@dataclass
class Tree:
    """``levels[k]``: the nodes of level k in groups that have several there, with their siblings (level 0 is derived anew when read, from ``leaves``); ``ends[k]``: the groups whose root stands on level k."""

    leaves: DataFrame
    levels: list[DataFrame]
    ends: list[DataFrame]

    def roots(self) -> DataFrame:
        """(g, h)"""
        out = self.ends[0]
        for e in self.ends[1:]:
            out = out.unionByName(e)
        return out

    def paths(self, top: DataFrame) -> DataFrame:
        """Adds the path from each leaf to the root of all, and the other columns of top: (g, path, ...), where path leads on from the group's root."""
        tail = [c for c in top.columns if c not in ("g", "path")]
        ended = lambda k: self.ends[k].select("g").join(top, "g").withColumn("i", F.lit(0).cast("long"))
        over = ended(-1)
        for k in range(len(self.levels) - 1, -1, -1):
            own = F.array(F.struct("before", "after")).cast(PATH)
            up = over.select("g", F.col("i").alias("up"), F.col("path").alias("_path"), *tail)
            met = self.levels[k].join(up, ["g", "up"]).withColumn("path", F.concat(own, "_path"))
            if k == 0:
                one = self.leaves.where("n = 1").join(top, "g")
                return met.select(*one.columns).unionByName(one)
            over = met.select("g", "i", "path", *tail).unionByName(ended(k).select("g", "i", "path", *tail))
        return self.leaves.join(top, "g")


def grow(leaves: DataFrame) -> Tree:
    """leaves: (g, i, n, h, ...), staged."""
    levels, ends = [], []
    nodes = leaves
    most = leaves.agg(F.max("n")).first()[0] or 0
    while True:
        ends.append(nodes.where("n = 1").select("g", "h"))
        if most <= 1:
            return Tree(leaves, levels, ends)
        grown = level(nodes.where("n > 1"))
        # The siblings of leaves are many: they are not written, but derived again where they are read.
        levels.append(grown if not levels else stage(grown, "level"))
        nodes = stage(parents(levels[-1]), "nodes")
        most = -(-most // FAN)


def manifest(docs: DataFrame, doc_id: str = "doc_id", group: str = "source", fields: tuple[str, ...] = FIELDS, extra: dict[str, Column] | None = None) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, and path, the siblings before and after on each level. extra: further columns to carry along."""
    configure(docs.sparkSession)
    leaf = leaf_hash(*[docs[c] for c in fields])
    rows = docs.select(docs[doc_id].alias("doc_id"), group_key(docs[group]).alias("g"), leaf.alias("h"), F.monotonically_increasing_id().alias("_u"), *[v.alias(k) for k, v in (extra or {}).items()])
    tree = grow(stage(placed(stage(rows, "leaves"), "doc_id", "h", "_u").drop("_u"), "leaves"))
    groups = stage(tree.roots().select(F.lit("").alias("g"), F.col("g").alias("name"), "h"), "groups")
    crown = grow(stage(placed(groups, "name"), "groups"))
    root = crown.roots().first()
    start = crown.roots().select("g", F.array().cast(PATH).alias("path"))
    above = stage(crown.paths(start).select(F.col("name").alias("g"), F.col("h").alias("subroot"), "path"), "above")
    return tree.paths(above).select("doc_id", F.col("h").alias("leaf"), "subroot", F.lit(root.h if root else None).cast("string").alias("root"), "path", *(extra or {}))


def proof(path: Column) -> Column:
    """All siblings of a path, from the leaf's level up."""
    return F.array_join(F.transform(path, lambda x: F.concat(x["before"], x["after"])), "")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda h, x: F.sha2(F.concat(x["before"], h, x["after"]), 256))


def tampered(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Column:
    """Where 5 divides the CRC-32 of the id, the text with A-Z lower-cased; elsewhere as it is."""
    low = F.translate(docs[text], "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(F.crc32(docs[doc_id].cast("string")) % 5 == 0, low).otherwise(docs[text])


def report(docs: DataFrame, doc_id: str = "doc_id", group: str = "source", fields: tuple[str, ...] = FIELDS, text: str = "text") -> DataFrame:
    """The manifest, and which rows still verify after some texts have been changed."""
    other = leaf_hash(*[tampered(docs, doc_id, text) if c == text else docs[c] for c in fields])
    m = manifest(docs, doc_id, group, fields, {"other": other})
    out = m.select("doc_id", "leaf", "subroot", "root", F.sha2(proof(F.col("path")), 256).alias("proof_sha256"), fold(F.col("other"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
