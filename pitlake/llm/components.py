"""Connected components of an undirected graph, by hooking, pointer jumping and contraction.

Each round every node hooks to its smallest neighbour if that is smaller than itself;
pointer jumping flattens the resulting trees; edges are rewritten to tree roots and
repeated ones dropped. The number of edges falls with every round, and rounds with the
logarithm of the longest path. Every step is a join or a partial aggregation that a hot
node cannot concentrate: skewed sides of the joins are split, minima are pre-aggregated.
Each round is written to the shared folder, so a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlake.llm.common import discard, written


def _through(df: DataFrame, column: str, roots: DataFrame) -> DataFrame:
    """``column`` replaced by its root where it has one."""
    side = roots.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    joined = df.join(side, df[column] == side["_node"], "left")
    return joined.withColumn(column, F.coalesce("_root", column)).drop("_node", "_root")


def _flattened(hooks: DataFrame) -> DataFrame:
    """(node, root): every node's pointer followed to the end."""
    roots = hooks
    while True:
        side = roots.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
        joined = roots.join(side, roots["root"] == side["_node"], "left")
        after = written(
            joined.select("node", F.coalesce("_root", "root").alias("root"), F.col("_root").isNotNull().alias("moved")), "jump"
        )
        moved = after.where("moved").limit(1).count()
        discard(roots)
        roots = after.drop("moved")
        if not moved:
            return roots


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every end of ``edges`` (a, b: long); component is the smallest node reachable.

    Loops, repeated and reversed edges are allowed; rows with a null end are ignored.
    Without edges the result is empty.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pairs = written(pairs, "edges")
    labels = None
    while True:
        if not pairs.limit(1).count():
            break
        hooks = written(pairs.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")), "hooks")
        roots = _flattened(hooks)
        ends = _through(_through(pairs, "a", roots), "b", roots).where("a <> b")
        after = written(ends.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
        if labels is None:
            labels = roots
        else:
            # Nodes labelled earlier follow their label; roots of this round that had no label yet get one.
            moved = _through(labels, "root", roots)
            fresh = roots.join(labels.select("node"), "node", "left_anti")
            labels, before = written(moved.unionByName(fresh), "labels"), labels
            discard(before)
            discard(roots)
        discard(pairs)
        pairs = after
    discard(pairs)
    if labels is None:
        spark = edges.sparkSession
        return spark.createDataFrame([], "node long, component long")
    tops = labels.select(F.col("root").alias("node")).distinct().join(labels.select("node"), "node", "left_anti")
    return (
        labels.select("node", F.col("root").alias("component"))
        .unionByName(tops.select("node", F.col("node").alias("component")))
    )
