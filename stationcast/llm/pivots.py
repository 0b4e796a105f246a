"""Links inside a hot group without comparing all its pairs, by a pivot.

Take any set P as pivot, and for every set x of the group its difference
D(x) = x ^ P.  Two sets are linked where their symmetric difference is at most
B = (|x| + |y|) (100 - percent) / (100 + percent).  It is |D(x)| + |D(y)| less
twice what the differences share.  If they share nothing and x and y are
linked, then both are linked with P as well:

    |D(x)| <= B - |D(y)| <= (|x| + |P| + |D(y)|) c - |D(y)| <= (|x| + |P|) c,

with c = (100 - percent) / (100 + percent).  So all pairs whose members are both
linked with P are in one component without a comparison, and any other linked
pair must share at least (|D(x)| + |D(y)| - B) / 2 elements, one at least, of
its differences.  That is an overlap join: every difference gives its first
elements in an order that holds for the whole group, enough that two with so
much in common must meet in one, and only members that meet are candidates.

The order: first what the members have and the pivot has not, rarest in the
group first; then what the pivot has, which all members far from it lack
together.  So those last are hardly ever dealt out, only where a member has too
little of its own.  Elements that only one member has never meet anything, so
near copies, which differ from their pivot mostly in words of their own, and
texts that have little but the pivot's passage in common, give hardly any
candidate.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationcast.llm.common import map_batches, staged
from stationcast.operators.common import BROADCAST_MAX_BYTES, bounded


def _arrays(column: pa.Array) -> list[np.ndarray]:
    values, offsets = column.flatten().to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    offsets = offsets - offsets[0]
    return [values[a:b] for a, b in zip(offsets, offsets[1:])]


def differences(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(pivot, rep, tag, n, pivot_n, linked, own, lack) of every member's set with its
    pivot: the elements that only the member has, and those that only the pivot has.

    ``sets`` is (rep, tag, n, set): distinct longs in rising order.  A number may
    have several sets, told apart by ``tag``; a pivot stands for its first one."""
    pivots = members.select(F.col("pivot").alias("rep")).distinct()
    base = staged(sets.join(bounded(pivots), "rep", "left_semi").groupBy("rep").agg(F.min_by("set", "tag").alias("pivot_set")).withColumnRenamed("rep", "pivot"), "pivot-sets")
    elements = base.agg(F.coalesce(F.sum(F.size("pivot_set").cast("long") + 4), F.lit(0))).first()[0]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sides = list(zip(_arrays(batch.column("set")), _arrays(batch.column("pivot_set"))))
        own, lack = ([np.setdiff1d(*x, assume_unique=True) for x in both] for both in (sides, [x[::-1] for x in sides]))
        n, m = (np.diff(batch.column(c).offsets.to_numpy()) for c in ("set", "pivot_set"))
        d = np.array([len(x) + len(y) for x, y in zip(own, lack)])
        linked = 100 * (n + m - d) >= percent * (n + m + d)  # twice the common part and the union
        return pa.RecordBatch.from_arrays([batch.column("pivot"), batch.column("rep"), batch.column("tag"), pa.array(n.astype(np.int64)), pa.array(m.astype(np.int64)), pa.array(linked),
                                           pa.array(own, pa.list_(pa.int64())), pa.array(lack, pa.list_(pa.int64()))], ["pivot", "rep", "tag", "n", "pivot_n", "linked", "own", "lack"])
    pairs = sets.join(bounded(members.select("pivot", "rep").distinct()), "rep")
    pairs = pairs.join(F.broadcast(base) if 8 * elements <= BROADCAST_MAX_BYTES else base, "pivot").select("pivot", "rep", "tag", "set", "pivot_set")
    return map_batches(pairs, run, "pivot long, rep long, tag long, n long, pivot_n long, linked boolean, own array<bigint>, lack array<bigint>")


def _needs(percent: int) -> Column:
    """Least number of elements that a member's difference shares with that of any
    linked partner, if at least one of the two is not linked with the pivot."""
    c = (100 - percent) / (100 + percent)
    far = F.col("d") - F.floor(F.col("n") * (100 - percent) / percent)
    near = F.ceil((F.col("d") + c * (F.col("pivot_n") - F.col("n"))) / 2 - 1e-9)
    return F.greatest(F.lit(1), F.when(F.col("linked"), near).otherwise(far)).cast("long")


def hot_links(members: DataFrame, sets: DataFrame, labels: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(links with pivots (a, b), candidates (a, b)) of groups (pivot, rep).

    Every linked pair of a group whose members have different ``labels`` (id,
    component) is a candidate, or follows from links with the pivot."""
    own = staged(differences(members, sets, percent), "pivot-differences")
    links = own.where(F.col("linked") & (F.col("pivot") != F.col("rep"))).select(F.greatest("pivot", "rep").alias("a"), F.least("pivot", "rep").alias("b")).distinct()
    who = ["pivot", "rep", "tag"]
    sized = own.withColumn("d", F.size("own") + F.size("lack")).withColumn("need", _needs(percent)).where(F.col("need") <= F.col("d"))
    elements = staged(sized.select(*who, F.explode("own").alias("h")), "pivot-elements")
    common = elements.groupBy("pivot", "h").agg(F.count("*").alias("f")).where(F.col("f") > 1)
    shared = elements.join(common, ["pivot", "h"]).groupBy(*who).agg(F.array_sort(F.collect_list(F.struct("f", "h"))).alias("shared"))  # one text's elements
    reach = F.col("d") - F.col("need") + 1 - F.size("own")
    able = sized.withColumn("last", F.slice("lack", F.lit(1), F.greatest(F.lit(0), reach).cast("int"))).withColumn("lacks", F.size("lack")).drop("own", "lack").join(shared, who, "left")
    able = able.withColumn("shared", F.coalesce(F.transform("shared", lambda e: e["h"]), F.array().cast("array<bigint>")))
    able = (able.withColumn("s", F.size("shared") + F.col("lacks")).where(F.col("s") >= F.col("need"))
            .withColumn("first", F.concat(F.slice("shared", F.lit(1), F.greatest(F.lit(0), F.col("s") - F.col("need") + 1).cast("int")), "last")))
    known = labels.select(F.col("id").alias("rep"), F.col("component").alias("c"))
    able = able.drop("shared", "last").join(bounded(known), "rep", "left").withColumn("c", F.coalesce("c", "rep"))
    first = staged(able.select(*who, "c", "n", "d", "s", "linked", F.posexplode("first").alias("at", "h")), "pivot-first")
    names = ["rep", "c", "n", "d", "s", "at"]
    one = first.where(~F.col("linked")).select("pivot", "h", *[F.col(x).alias(f"{x}_x") for x in names])
    two = first.select("pivot", "h", F.col("linked").alias("linked_y"), *[F.col(x).alias(f"{x}_y") for x in names])
    share = F.least(F.col("s_x") - F.col("at_x"), F.col("s_y") - F.col("at_y"))  # if they meet here first
    enough = 2 * (100 + percent) * share >= (100 + percent) * (F.col("d_x") + F.col("d_y")) - (100 - percent) * (F.col("n_x") + F.col("n_y"))
    alike = 100 * F.least("n_x", "n_y") >= percent * F.greatest("n_x", "n_y")
    once = F.col("linked_y") | (F.col("rep_x") > F.col("rep_y"))
    met = one.join(two, ["pivot", "h"]).where((F.col("c_x") != F.col("c_y")) & alike & enough & once)
    return links, met.select(F.greatest("rep_x", "rep_y").alias("a"), F.least("rep_x", "rep_y").alias("b")).distinct()
