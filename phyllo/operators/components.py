"""Connected components by Hash-to-Min, as relations: no cluster is ever held in one row or task.

Every node keeps a cluster, one row (node, member) for each member but itself. In a round each node finds the minimum of
its cluster, sends the whole cluster to that minimum and the minimum to every member. The links stay symmetric, so once
every node that is no minimum knows nothing but its minimum, the stars are the components. A round costs one aggregation
(with map-side combine), one join and one distinct over rows of two longs; the rows of a hot node are split by adaptive
skew handling, as its minimum is joined back instead of being computed over a window. Each round ends at a written table
in the shared folder, and the test for the end is observed while the round is written, so it takes no job of its own.

Nodes are renamed by a reversible mix of their bits first: along a chain whose names ascend every cluster would double
in each round until all hold all of it, while in a random order the sum of the clusters stays near the number of nodes.

Defined results: an edge with a null end is ignored; a loop alone makes no component, so its node is absent; repeated
edges count once; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from phyllo.session import materialize, release

LOW = (1 << 32) - 1


def _half(x: Column) -> Column:
    return F.xxhash64(x).bitwiseAND(F.lit(LOW).cast("long"))


def mixed(v: Column) -> Column:
    """Another long for each long, in no order: two rounds of a Feistel network over the halves."""
    low, high = v.bitwiseAND(F.lit(LOW).cast("long")), F.shiftrightunsigned(v, 32)
    first = high.bitwiseXOR(_half(low))
    return F.shiftleft(first, 32).bitwiseOR(low.bitwiseXOR(_half(first)))


def unmixed(m: Column) -> Column:
    """The long that ``mixed`` made m of."""
    first = F.shiftrightunsigned(m, 32)
    low = m.bitwiseAND(F.lit(LOW).cast("long")).bitwiseXOR(_half(first))
    return F.shiftleft(first.bitwiseXOR(_half(low)), 32).bitwiseOR(low)


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node with a link in ``edges`` (two bigint columns); root is the component's smallest node."""
    ends = edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).where("a <> b").select(mixed(F.col("a")).alias("a"), mixed(F.col("b")).alias("b"))
    pair = lambda x, y: F.inline(F.array(F.struct(x.alias("v"), y.alias("u")), F.struct(y.alias("v"), x.alias("u"))))
    c = materialize(ends.select(pair(F.col("a"), F.col("b"))).distinct(), "hash-to-min")
    if c.isEmpty():
        return c.select(F.col("v").alias("node"), F.col("u").alias("root"))
    for _ in range(max_rounds):
        low = c.groupBy("v").agg(F.least(F.min("u"), F.first("v")).alias("m"))
        watch = Observation()
        seen = c.join(low, "v").observe(watch, F.count_if((F.col("m") < F.col("v")) & (F.col("u") != F.col("m"))).alias("open"))
        # the minimum itself hears of v; every other member is sent to the minimum, and the minimum to it
        other = F.when(F.col("u") == F.col("m"), F.col("v")).otherwise(F.col("u"))
        after = materialize(seen.select(pair(F.col("m"), other)).distinct(), "hash-to-min")
        still = watch.get["open"]
        release(c)
        c = after
        if not still:
            stars = c.groupBy("v").agg(F.least(F.min("u"), F.first("v")).alias("m"))
            names = stars.groupBy("m").agg(F.min(unmixed(F.col("v"))).alias("root"))
            return stars.join(names, "m").select(unmixed(F.col("v")).alias("node"), "root")
    raise RuntimeError(f"components are not stable after {max_rounds} rounds")
