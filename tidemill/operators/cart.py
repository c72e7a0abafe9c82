"""Regression trees with exact splits, grown level by level.

At every level each value of each feature is a possible split of its node. Rows are added up per (node, feature, value),
dealt into ranges of that order, and running sums within the ranges plus the sums of the ranges before give count and
sum on both sides of every split. So a node that holds all rows is many ranges, and only one best split per node, at
most two to the power of the depth, comes to the driver.

Targets enter as whole millionths: their sums are exact, and the tree does not depend on the order of rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.session import written

SCALE = 1_000_000


@dataclass(frozen=True)
class Node:
    """A node by its number: 1 is the root, the children of n are 2n (feature <= threshold) and 2n + 1."""

    number: int
    n: int
    total: int
    feature: int | None = None
    threshold: float | None = None
    gain: float = 0.0

    @property
    def prediction(self) -> float:
        return self.total / self.n / SCALE


@dataclass(frozen=True)
class Tree:
    features: tuple[str, ...]
    nodes: dict[int, Node]

    @property
    def depth(self) -> int:
        return max(self.nodes).bit_length() - 1

    def importance(self, spark: SparkSession) -> DataFrame:
        """(feature, importance): its share of what all splits took from the squared error, largest first."""
        gained = [sum(n.gain for n in self.nodes.values() if n.feature == i) for i in range(len(self.features))]
        whole = sum(gained)
        rows = [(f, g / whole if whole else 0.0) for f, g in zip(self.features, gained, strict=True)]
        return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")

    def rules(self, spark: SparkSession) -> DataFrame:
        """(line_no, node, depth, feature, threshold, n_rows, prediction) from the root down, left before right."""
        def below(number: int):
            if number in self.nodes:
                yield self.nodes[number]
                yield from below(2 * number)
                yield from below(2 * number + 1)

        rows = [(i, n.number, n.number.bit_length() - 1, None if n.feature is None else self.features[n.feature], n.threshold,
                 n.n, n.prediction) for i, n in enumerate(below(1) if self.nodes else ())]
        return spark.createDataFrame(rows, "line_no int, node long, depth int, feature string, threshold double, n_rows long, "
                                           "prediction double")

    def predicted(self) -> Column:
        """The prediction for a row with the tree's features as columns."""
        def of(number: int) -> Column:
            node = self.nodes[number]
            if node.feature is None:
                return F.lit(node.prediction)
            left = F.col(f"`{self.features[node.feature]}`").cast("double") <= F.lit(node.threshold)
            return F.when(left, of(2 * number)).otherwise(of(2 * number + 1))

        return of(1) if self.nodes else F.lit(None).cast("double")


def running(sums: DataFrame, keys: Sequence[str], value: str, counted: Sequence[str]) -> DataFrame:
    """``sums`` with ``upto_<c>`` for each counted column, added up to the row in the order of ``value`` within the keys,
    and ``next``, the value that follows.

    Rows are range-partitioned, so no group is held by one task; each range adds what the ranges before it hold.
    """
    ranged = sums.repartitionByRange(*keys, value).withColumn("part", F.spark_partition_id())
    along = Window.partitionBy("part", *keys).orderBy(value)
    held = written(ranged.withColumns({
        **{f"upto_{c}": F.sum(c).over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow)) for c in counted},
        "next": F.lead(value).over(along)}), "ranges")
    # One row for each range a group reaches into.
    parts = held.groupBy("part", *keys).agg(*[F.sum(c).alias(f"part_{c}") for c in counted], F.min(value).alias("first"))
    before = Window.partitionBy(*keys).orderBy("part")
    earlier = before.rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("part", *keys, *[F.coalesce(F.sum(f"part_{c}").over(earlier), F.lit(0)).alias(f"before_{c}")
                                            for c in counted], F.lead("first").over(before).alias("following"))
    joined = held.join(offsets, ["part", *keys])
    return joined.withColumns({f"upto_{c}": F.col(f"upto_{c}") + F.col(f"before_{c}") for c in counted}).withColumn(
        "next", F.coalesce("next", "following")).drop("part", "following", *[f"before_{c}" for c in counted])


def best_splits(rows: DataFrame, totals: DataFrame) -> DataFrame:
    """(node, feature, threshold, gain): the split of each node that lowers the squared error most.

    Ties go to the feature that comes first, then to the smaller threshold, which lies midway between two values.
    """
    values = rows.select("node", "y", F.posexplode("x").alias("feature", "value"))
    sums = values.groupBy("node", "feature", "value").agg(F.count("*").alias("n"), F.sum("y").alias("s"))
    cuts = running(sums, ["node", "feature"], "value", ["n", "s"]).filter("next IS NOT NULL").join(
        totals.select("node", "total", "n_rows"), "node")
    left, right = F.col("upto_s").cast("double"), (F.col("total") - F.col("upto_s")).cast("double")
    score = left * left / F.col("upto_n") + right * right / (F.col("n_rows") - F.col("upto_n"))
    whole = F.col("total").cast("double") * F.col("total").cast("double") / F.col("n_rows")
    threshold = (F.col("value") + F.col("next")) / 2
    order = F.struct(score.alias("score"), (-F.col("feature")).alias("f"), (-threshold).alias("t"))
    best = cuts.select("node", order.alias("order"), whole.alias("whole")).groupBy("node").agg(
        F.max("order").alias("best"), F.first("whole").alias("whole"))
    return best.select("node", (-F.col("best.f")).alias("feature"), (-F.col("best.t")).alias("threshold"),
                       (F.col("best.score") - F.col("whole")).alias("gain"))


def grow(df: DataFrame, features: Sequence[str], target: str, depth: int = 4) -> Tree:
    """The tree of the rows without gaps in features or target.

    A node is split until all its targets are equal, no feature has two values or ``depth`` is reached. No rows give a
    tree without nodes. Targets are rounded to millionths.
    """
    numbers = df.select(F.array(*[F.col(f"`{c}`").cast("double") for c in features]).alias("x"),
                        F.round(F.col(f"`{target}`").cast("double") * SCALE).alias("y"))
    whole = numbers.filter(F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v)) & F.col("y").isNotNull() & ~F.isnan("y"))
    rows = written(whole.select(F.lit(1).cast("long").alias("node"), "x", F.col("y").cast("long").alias("y")), "tree-rows")
    nodes: dict[int, Node] = {}
    for level in range(depth + 1):
        totals = written(rows.groupBy("node").agg(
            F.count("*").alias("n_rows"), F.sum("y").alias("total"), (F.min("y") < F.max("y")).alias("mixed")), "node-totals")
        known = {r["node"]: r for r in totals.collect()}
        splits = {}
        if level < depth and any(r["mixed"] for r in known.values()):
            mixed = rows.join(F.broadcast(totals.filter("mixed").select("node")), "node", "left_semi")
            splits = {r["node"]: r for r in best_splits(mixed, totals).collect()}
        for number, r in known.items():
            s = splits.get(number)
            nodes[number] = Node(number, r["n_rows"], r["total"], *((s["feature"], s["threshold"], s["gain"]) if s else ()))
        if not splits:
            break
        table = df.sparkSession.createDataFrame([(n, s["feature"], s["threshold"]) for n, s in splits.items()],
                                                "node long, feature int, threshold double")
        side = (F.element_at("x", F.col("feature") + 1) > F.col("threshold")).cast("long")
        rows = written(rows.join(F.broadcast(table), "node").select((2 * F.col("node") + side).alias("node"), "x", "y"), "tree-rows")
    return Tree(tuple(features), nodes)
