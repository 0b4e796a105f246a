"""Connected components of a link table, by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationcast.llm.common import staged
from stationcast.operators.common import BROADCAST_MAX_BYTES, bounded, measured_bytes


#: Bytes of links that a task takes in a round.
TASK_BYTES = 1 << 20


def _star(edges: DataFrame, large: bool, few: bool, tasks: int) -> DataFrame:
    """Links each vertex's neighbours (the larger ones, or the not larger ones) to
    the least vertex around it.  Degrees are only combined by ``min``, which
    tasks do first, and the join that follows is one Spark can split by skew, or
    a broadcast where vertices are ``few``.  Few links go to as few ``tasks``."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    least = F.broadcast(least.coalesce(tasks)) if few else least
    joined = both.join(least, "u")
    if large:  # no more rows than edges; equal ones fall together in the small star
        return joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).where(F.col("u") != F.col("v"))
    out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    out = out.where(F.col("u") != F.col("v")).distinct()
    return out.coalesce(tasks) if few else out


def _stars_only(edges: DataFrame, few: bool, tasks: int) -> bool:
    """Whether the links (u > v) are stars around their least vertices: no vertex hangs
    on two, or on one while another hangs on it."""
    ends = edges.select(F.inline(F.array(F.struct(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")),
                                         F.struct(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))))
    held = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not (held.coalesce(tasks) if few else held).agg(F.max((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0)))).first()[0]


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every vertex of ``edges`` (a, b); component is the least
    vertex that can be reached.  Rounds grow with the logarithm of the largest
    component; each round is written to the shared folder, so lost executors
    cost no more than a round."""
    e = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    return _settled(staged(e, "components"))


def _settled(e: DataFrame) -> DataFrame:
    """The components of written distinct links (u > v)."""
    size = 2 * measured_bytes(e)  # no edge has more than two vertices
    few, tasks = size <= BROADCAST_MAX_BYTES, -(-size // TASK_BYTES) or 1
    while not _stars_only(e, few, tasks):
        e = staged(_star(_star(e, True, few, tasks), False, few, tasks), "components")
    stars, heads = e.select(F.col("u").alias("id"), F.col("v").alias("component")), e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return stars.unionByName(heads.coalesce(tasks) if few else heads)


def grown(comps: DataFrame, edges: DataFrame) -> DataFrame:
    """The components when ``edges`` (a, b) come to those that ``comps`` (id, component)
    holds already.  Only links between different components are followed, as links
    of their least vertices, so what is settled is not gone through again.
    ``comps`` is read several times and should be written."""
    apart, few = edges.select("a", "b"), measured_bytes(comps) <= BROADCAST_MAX_BYTES
    for end in ("a", "b"):
        known = comps.select(F.col("id").alias(end), F.col("component").alias(f"of_{end}"))
        apart = apart.join(F.broadcast(known) if few else known, end, "left").withColumn(f"of_{end}", F.coalesce(f"of_{end}", end))
    apart = staged(apart.where(F.col("of_a") != F.col("of_b")).select(F.greatest("of_a", "of_b").alias("a"), F.least("of_a", "of_b").alias("b")).distinct(), "components-apart")
    if apart.isEmpty():
        return comps
    merged = _settled(apart.toDF("u", "v"))
    moved = (comps.join(bounded(merged.select(F.col("id").alias("component"), F.col("component").alias("now"))), "component", "left")
             .select("id", F.coalesce("now", "component").alias("component")))
    ids = comps.select("id")
    return staged(moved.unionByName(merged.join(F.broadcast(ids) if few else ids, "id", "left_anti").select("id", "component")), "components-grown")
