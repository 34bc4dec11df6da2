"""Sharding by a hierarchical weighted hash tree (region -> rack -> shard).

Every shard draws an exponential variate from a hash of the document id and the
shard's name, divided by its weight; a rack's draw is the least of its shards',
a region's the least of its racks', which is again an exponential draw, by the
weight of the whole subtree.  A document descends into the child with the
smallest draw.  A child is chosen with probability proportional to its weight,
and a weight change moves documents only into (growth) or out of (shrinkage) the
subtrees whose weights change, because all other draws stay as they are.  The
draws of a grown subtree become smaller only where the new shard's own draw is
the least, so one more shard takes rows into itself alone, for any number of
shards and wherever in the tree it is put.

Everything is column expressions: no Python touches a row.

Null and odd input: a null id draws like any other value (all null ids share a
shard), a null text has size ``overhead`` and the CRC of an empty text, equal
rows get different slots, an empty table gives an empty result.  Extra columns
are ignored.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.common import staged

#: Sub-blocks of an input partition in which slots are numbered.
SLOT_SALT = 4


@dataclass(frozen=True)
class Node:
    """A region, rack or shard; a leaf carries its shard number."""
    name: str
    children: tuple["Node", ...] = ()
    shard: int | None = None
    own_weight: float = 1.0

    @property
    def weight(self) -> float:
        return sum(c.weight for c in self.children) if self.children else self.own_weight


def topology(n_shards: int, shards_per_rack: int = 4, racks_per_region: int = 2,
             weights: dict[int, float] | None = None) -> Node:
    """The default tree: shards fill racks, racks fill regions, in order.

    One more shard joins the last rack or opens a rack or region: its own path is all that changes weight.
    """
    if n_shards < 1:
        raise ValueError("at least one shard is needed")
    per_region = shards_per_rack * racks_per_region
    regions = []
    for r in range(0, n_shards, per_region):
        racks = []
        for k in range(r, min(r + per_region, n_shards), shards_per_rack):
            leaves = tuple(Node(f"s{s}", shard=s, own_weight=(weights or {}).get(s, 1.0))
                           for s in range(k, min(k + shards_per_rack, n_shards)))
            racks.append(Node(f"r{r // per_region}k{k // shards_per_rack}", leaves))
        regions.append(Node(f"r{r // per_region}", tuple(racks)))
    return Node("root", tuple(regions))


def draw(key: Column, node: Node) -> Column:
    """Exponential draw of a node for a key: -ln(u) / weight of a shard, u in (0, 1); the least of the children's above."""
    if node.shard is None:
        kids = [draw(key, c) for c in node.children if c.weight > 0]
        return F.least(*kids) if len(kids) > 1 else kids[0]
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(node.name), key), 11)
    u = (bits.cast("double") + F.lit(0.5)) * F.lit(2.0 ** -53)
    return -F.log(u) / F.lit(float(node.weight))


def descend(key: Column, node: Node) -> Column:
    """The shard reached from ``node``: at each level the child with the least draw."""
    if node.shard is not None:
        return F.lit(node.shard)
    kids = [c for c in node.children if c.weight > 0]
    if len(kids) == 1:
        return descend(key, kids[0])
    best = F.array_min(F.array(*[F.struct(draw(key, c).alias("d"), F.lit(i).alias("i"))
                                 for i, c in enumerate(kids)]))["i"]
    if all(c.shard is not None for c in kids):
        return F.element_at(F.array(*[F.lit(c.shard) for c in kids]), best + 1)
    out = None
    for i, c in enumerate(kids):
        out = F.when(best == i, descend(key, c)) if out is None else out.when(best == i, descend(key, c))
    return out


def assign(docs: DataFrame, n_shards: int = 24, id_col: str = "doc_id", text_col: str = "text",
           overhead: int = 8, tree: Node | None = None, grown: Node | None = None) -> DataFrame:
    """One row per document: size, text_crc32, shard, slot in the shard, shard after growth.

    ``grown`` defaults to the tree with one more shard.  Slots are gapless from
    0 in every shard: rows are numbered inside (shard, input partition, salt)
    blocks, and each block is shifted by the counts of the blocks before it, so
    no task ever holds a whole shard.
    """
    tree = tree or topology(n_shards)
    grown = grown or topology(n_shards + 1)
    data = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    key = F.col(id_col).cast("string")
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(data).cast("long") + F.lit(overhead).cast("long")).alias("size"),
        F.crc32(data).alias("text_crc32"),
        descend(key, tree).cast("int").alias("shard"),
        descend(key, grown).cast("int").alias("grown_shard"),
        F.spark_partition_id().alias("pid"),
        F.pmod(F.monotonically_increasing_id(), F.lit(SLOT_SALT)).cast("int").alias("salt"))
    rows = staged(rows, "shard-rows")
    block = ["shard", "pid", "salt"]
    before = Window.partitionBy("shard").orderBy("pid", "salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy(*block).count().select(
        *block, F.coalesce(F.sum("count").over(before), F.lit(0)).cast("long").alias("start"))
    local = F.row_number().over(Window.partitionBy(*block).orderBy("doc_id", "text_crc32", "size"))
    numbered = rows.withColumn("local", local)
    return numbered.join(starts, block).select(
        "doc_id", "size", "text_crc32", "shard",
        (F.col("start") + F.col("local") - 1).alias("slot"), "grown_shard")


def moved(assigned: DataFrame) -> DataFrame:
    """Documents whose shard changes when the tree grows: (doc_id, from shard, to shard)."""
    return assigned.where(F.col("shard") != F.col("grown_shard")).select(
        "doc_id", F.col("shard").alias("from_shard"), F.col("grown_shard").alias("to_shard"))
