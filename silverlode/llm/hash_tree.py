"""Sharding by a hierarchical weighted hash tree, in DataFrame functions only.

A tree has regions, racks and shards; a node weighs what its shards weigh. A key descends level by level: each child
draws u in (0, 1) from the key and the child's path, and the child with the least -ln(u) / weight is taken, so that a
child is taken in proportion to its weight. A draw depends on nothing but key and path: where the weight of a
shard changes, siblings compare differently only on the path to it, and a key moves only into or out of
the subtrees whose weights changed. ``grown`` adds a shard in a region of its own, so that it takes keys only into itself; a
shard put into a rack that exists also raises its rack and region, and their other shards take keys too.

``place`` gives every row its shard; ``slots`` numbers the rows of every shard from 0 without a gap. The numbering sorts
(shard, key, crc32, size, row) by range, so that neither a shard nor a key with a third of all rows is one task, and
adds the counts of the partitions before; it orders by key, then crc32, then size.

Cases: a null key draws as the text 'null' and is placed like any other; a null text has no bytes and crc32 0; rows with the
same key share a shard, however often they come, and get slots of their own; an empty table gives an empty result. Only
the key and the columns made here are returned; all others, whatever their names, are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverlode.llm.frames import stored

BITS = 52
Tree = dict[int, dict[int, dict[int, float]]]


def standard_tree(shards: int, racks: int = 2, per_rack: int = 4) -> Tree:
    """Shards 0 .. ``shards`` - 1 of weight 1, filled rack by rack, region by region."""
    tree: Tree = {}
    for shard in range(shards):
        rack = shard // per_rack
        tree.setdefault(rack // racks, {}).setdefault(rack, {})[shard] = 1.0
    return tree


def grown(tree: Tree, weight: float = 1.0) -> Tree:
    """The tree with one more shard, numbered after all others, in a region and rack of its own."""
    shards = [s for racks in tree.values() for members in racks.values() for s in members]
    racks = [r for own in tree.values() for r in own]
    return tree | {max(tree, default=-1) + 1: {max(racks, default=-1) + 1: {max(shards, default=-1) + 1: weight}}}


def _weight(node: dict | float) -> float:
    return sum(map(_weight, node.values())) if isinstance(node, dict) else float(node)


def _draw(key: Column, path: str) -> Column:
    """A uniform number in (0, 1) from key and path."""
    digits = F.substring(F.md5(F.concat(key, F.lit(path)).cast("binary")), 1, BITS // 4)
    return (F.conv(digits, 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(float(1 << BITS))


def _taken(key: Column, node: dict, path: str) -> Column:
    """The child of ``node`` that the key draws; equal scores, which 52 bits hardly make, go to the smaller child."""
    children = [(name, _weight(child)) for name, child in sorted(node.items()) if _weight(child) > 0]
    if not children:
        raise ValueError("a tree needs a shard with a weight above 0")
    if len(children) == 1:
        return F.lit(children[0][0])
    scores = [F.struct((-F.ln(_draw(key, f"{path}/{n}")) / F.lit(w)).alias("score"), F.lit(n).alias("child")) for n, w in children]
    return F.array_min(F.array(*scores))["child"]


def _within(parent: Column, branches: list[tuple[int, Column]]) -> Column:
    column = F.lit(None).cast("int")
    for name, taken in reversed(branches):
        column = F.when(parent == name, taken).otherwise(column)
    return column


def with_shard(rows: DataFrame, key: str, tree: Tree, name: str = "shard") -> DataFrame:
    """``rows`` with the shard (int) that each key reaches: a region, a rack in it, a shard in that."""
    k, region, rack = F.coalesce(F.col(key).cast("string"), F.lit("null")), f"{name}_region", f"{name}_rack"
    live = {r: {q: m for q, m in own.items() if _weight(m) > 0} for r, own in tree.items() if _weight(own) > 0}
    racks = [(r, _taken(k, own, f"/{r}")) for r, own in live.items()]
    shards = [
        (r, _within(F.col(rack), [(q, _taken(k, members, f"/{r}/{q}")) for q, members in own.items()])) for r, own in live.items()
    ]
    down = rows.withColumn(region, _taken(k, live, "")).withColumn(rack, _within(F.col(region), racks))
    return down.withColumn(name, _within(F.col(region), shards).cast("int")).drop(region, rack)


def place(rows: DataFrame, tree: Tree, larger: Tree | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, size, text_crc32, shard, grown_shard): the shard in ``tree``, and in ``larger`` where given."""
    content = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    slim = rows.select(F.col(key), (F.length(content) + 8).cast("bigint").alias("size"), F.crc32(content).alias("text_crc32"))
    placed = with_shard(slim, key, tree)
    return with_shard(placed, key, larger, "grown_shard") if larger else placed.withColumn("grown_shard", F.lit(None).cast("int"))


def slots(placed: DataFrame, key: str = "doc_id") -> DataFrame:
    """``placed`` with ``slot``: the number of each row in its shard, by key, crc32 and size."""
    spark = placed.sparkSession
    known = stored(placed.withColumn("row", F.monotonically_increasing_id()), "placed")  # written: a row keeps its number
    order = ["shard", key, "text_crc32", "size", "row"]
    dealt = known.repartitionByRange(*order).sortWithinPartitions(*order)
    ranked = stored(dealt.withColumn("place", F.monotonically_increasing_id()).drop("row"), "ranked")
    part = F.shiftrightunsigned("place", 33).cast("int").alias("part")
    runs = ranked.groupBy("shard", part).agg(F.min("place").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = runs.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n").withColumnRenamed("shard", "own")
    # One row for each run of a shard in a partition: at most partitions and shards together.
    met = ranked.join(F.broadcast(bases), (F.col("shard") == F.col("own")) & (part == F.col("part")))
    return met.withColumn("slot", F.col("base") + F.col("place") - F.col("first")).drop("own", "part", "base", "first", "place")
