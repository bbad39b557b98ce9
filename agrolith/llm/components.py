"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .common import discarded, released, stored


def large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour instead."""
    both = links.select(F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    tied = both.where("b > a").join(least, "a")
    return tied.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of these."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    tied = down.join(least, "a")
    ends = F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))
    return tied.select(F.inline(ends)).where("a <> b").distinct()


def are_stars(links: DataFrame) -> bool:
    """Whether every node is tied to one smaller node that is tied to nothing smaller: then that one is its component."""
    centres = links.select(F.col("b").alias("a")).distinct().withColumn("centre", F.lit(True))
    per_node = links.groupBy("a").agg(F.count(F.lit(1)).alias("n")).join(centres, "a", "left")
    return per_node.where("n > 1 OR centre").limit(1).count() == 0


#: Links, a megabyte or so, up to which one task ties them all.
FEW_LINKS = 50_000


def tied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, component) of few links (a, b): each node points to a smaller one of its component, the smallest to itself."""
    above, kind = {}, None

    def top(node):
        while (over := above.setdefault(node, node)) != node:
            above[node] = node = above[over]
        return node

    for batch in batches:
        kind = batch.column(0).type
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            one, two = top(a), top(b)
            above[max(one, two)] = min(one, two)
    if nodes := [*above]:
        yield pa.RecordBatch.from_arrays([pa.array(nodes, kind), pa.array([*map(top, nodes)], kind)], ["node", "component"])


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) of the nodes in links (a, b: numbers or strings); component is the smallest node reachable.

    Rounds end when all links are stars. Lineage is cut by tables in the shared folder. A hub's links are joined with
    one row per node, which adaptive execution splits. Where links are few, the rounds' jobs and plans would cost more than
    their work, so one task ties them.
    """
    ordered = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = stored(ordered, "links")
    if links.count() <= FEW_LINKS:
        kind = links.schema["a"].dataType
        schema = StructType([StructField("node", kind), StructField("component", kind)])
        return links.coalesce(1).mapInArrow(tied, schema)
    while not are_stars(links):
        links, before = stored(small_star(large_star(links)), "links"), links
        discarded(before)
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


#: Partners that a node tries in a round, nodes of a list that are dealt to partners together, and the pairs that the
#: open lists may still have, by their rows, before every pair is met.
TRIES, DEALT, MANY = 16, 1000, 8


def open_lists(lists: DataFrame, classes: DataFrame) -> DataFrame:
    """(key, a, c, size, minor): the lists (key, a) with nodes of several components c, each with its number of nodes and
    whether the node is outside the list's largest component."""
    tagged = lists.join(classes.withColumnRenamed("node", "a"), "a", "left").select("key", "a", F.coalesce("component", "a").alias("c"))
    sizes = tagged.groupBy("key", "c").agg(F.count(F.lit(1)).alias("own"))
    whole = sizes.groupBy("key").agg(F.max(F.struct("own", "c")).alias("top"), F.count(F.lit(1)).alias("classes"), F.sum("own").alias("size"))
    several = whole.where("classes > 1").select("key", F.col("top.c").alias("major"), "size")
    return tagged.join(several, "key").select("key", "a", "c", "size", (F.col("c") != F.col("major")).alias("minor"))


def near_pairs(pairs: DataFrame, nodes: DataFrame, own: list[str], near) -> DataFrame:
    """The pairs (a, b) that near allows by what nodes hold."""
    both = pairs.join(nodes.select(F.col("node").alias("a"), *own), "a")
    both = both.join(nodes.select(F.col("node").alias("b"), *(F.col(x).alias(f"{x}_") for x in own)), "b")
    return both.where(near(F.col, lambda name: F.col(f"{name}_"))).select("a", "b")


def tried_pairs(opened: DataFrame, number: int) -> DataFrame:
    """TRIES pairs (a, b) a node at most: the nodes of an open list stand in the order of a hash that differs by list and
    round, and each meets the one behind it, if that is of another component. A long list is dealt to several parts,
    other ones each round, so no task gets a whole list."""
    mark = F.xxhash64("a", "key", F.lit(number))
    part = F.pmod(F.xxhash64("a", F.lit(number)), F.floor(F.col("size") / DEALT) + 1)
    order = W.partitionBy("key", "part").orderBy("mark", "a")
    behind = opened.withColumn("mark", mark).withColumn("part", part).withColumn("b", F.lead("a").over(order)).withColumn("c_", F.lead("c").over(order))
    met = behind.where("c <> c_").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"), F.abs("mark").alias("mark")).groupBy("a", "b").agg(F.min("mark").alias("mark"))
    chosen = W.partitionBy("a").orderBy("mark", "b")
    return met.withColumn("place", F.row_number().over(chosen)).where(F.col("place") <= TRIES).select("a", "b")


def cross_pairs(opened: DataFrame, nodes: DataFrame, own: list[str], near) -> DataFrame:
    """Pairs (a, b) of an open list whose nodes are in different components and are near, a outside the largest one.

    In each list only the nodes outside its largest component meet the rest, so a list whose nodes are already
    connected gives nothing, however long it is. The longer side is joined unaggregated, which adaptive execution splits.
    """
    held = stored(opened.join(nodes.select(F.col("node").alias("a"), *own), "a"), "lists")
    minor = held.where("minor").select("key", *(F.col(x).alias(f"{x}_") for x in ("a", "c", *own)))
    pairs = held.join(minor, "key").where((F.col("c") != F.col("c_")) & near(F.col, lambda name: F.col(f"{name}_")))
    once = ~F.col("minor") | (F.col("a_") > F.col("a"))
    return pairs.where(once).select(F.col("a_").alias("a"), F.col("a").alias("b")).distinct()


def closed(lists: DataFrame, links: DataFrame, nodes: DataFrame, own: list[str], near, verify) -> DataFrame:
    """links, with links added until no two near nodes of one list that verify would link are in different components.

    lists: (key, a), one row each. nodes: (node, *own). near takes two functions that give a column of either side;
    verify gives the pairs of those it takes that are links. While the open lists hold many pairs, nodes try a few each
    round, which joins large groups of similar nodes without their pairs; when a round finds less than an eighth of the
    links of the best one, what is open meets in full.
    """
    number, most, goes_on, opened = 0, 0, True, None
    while True:
        released()  # the plans of the rounds before
        opened, before = stored(open_lists(lists, connected_components(links)), "open"), opened
        discarded(before)
        rows, pairs = opened.agg(F.count(F.lit(1)), F.sum(F.when(F.col("minor"), F.col("size")).otherwise(0))).first()
        if not rows:
            return links
        if not goes_on or pairs <= MANY * rows:
            return stored(links.unionByName(verify(cross_pairs(opened, nodes, own, near))), "links")
        found = stored(verify(near_pairs(tried_pairs(opened, number), nodes, own, near)), "links")
        joined = found.count()
        most = max(most, joined)
        goes_on = joined * 8 > most
        links = links.unionByName(found)
        lists, number = opened.select("key", "a"), number + 1


BUCKETS = 1 << 18


def rows_wanted(rows: DataFrame, wanted: DataFrame, keys: tuple[str, ...] = ("row",)) -> DataFrame:
    """rows joined with wanted by keys. Rows that certainly aren't wanted are left out before the exchange, by a table
    of hashed keys with BUCKETS entries at most, which bounds what is broadcast."""
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS))
    present = wanted.select(bucket.alias("bucket")).distinct()
    return rows.join(F.broadcast(present), bucket == F.col("bucket"), "left_semi").join(wanted, list(keys))
