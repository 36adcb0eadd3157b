"""Connected components of an edge table by alternating star contractions.

Each round is a few joins and aggregations of the remaining edges and is
checkpointed to the shared folder; nothing is collected.  Rounds stop when the
edges are stars (every child has one parent, no parent is a child), which takes
a logarithmic number of rounds and none if they are stars to begin with.

The remaining edges are read in as many partitions as they fill at EDGES each:
what fits one partition contracts in one task without any shuffle, and a large
table shuffles as ever.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incidentlab.session import checkpoint

EDGES = 500_000  # edges a partition is filled with (16 bytes each)


def _hang(pairs: DataFrame) -> DataFrame:
    """Distinct edges (child, parent) with parent < child."""
    return (
        pairs.select(F.greatest("u", "v").alias("child"), F.least("u", "v").alias("parent"))
        .filter("child <> parent")
        .distinct()
    )


def _held(edges: DataFrame) -> DataFrame:
    """The edges, checkpointed, in partitions that are worth a task."""
    edges = checkpoint(edges)
    return edges.coalesce(max(1, -(-edges.count() // EDGES)))


def _two(df: DataFrame, names: tuple[str, str], *pairs: tuple[str, str]) -> DataFrame:
    """A row ``names`` for each pair of columns of every row."""
    rows = F.array(*(F.struct(*(F.col(c).alias(n) for c, n in zip(pair, names))) for pair in pairs))
    return df.select(F.inline(rows))


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, component)`` for every node that has an edge to another one;
    the component is its smallest node.  Null ends and self-edges are ignored."""
    pairs = edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).dropna()
    now = _held(_hang(pairs))
    while True:
        both = _two(now, ("u", "v"), ("child", "parent"), ("parent", "child"))
        least = both.groupBy("u").agg(
            F.least(F.min("v"), F.col("u")).alias("m"),
            F.count_if(F.col("v") < F.col("u")).alias("parents"),
            F.max(F.col("v") > F.col("u")).alias("parent"),
        )
        if not least.filter("parents > 1 OR (parents > 0 AND parent)").limit(1).count():
            break
        # Large star: all larger neighbours of a node hang on its smallest neighbour.
        large = both.filter("v > u").join(least.select("u", "m"), "u").filter("v <> m")
        large = large.select(F.greatest("v", "m").alias("child"), F.least("v", "m").alias("parent"))
        # Small star: all parents of a node, and the node, hang on its smallest parent.
        top = large.groupBy("child").agg(F.min("parent").alias("m"))
        small = _two(large.join(top, "child"), ("u", "v"), ("parent", "m"), ("child", "m"))
        now = _held(_hang(small))
    return _two(now, ("node", "component"), ("child", "parent"), ("parent", "parent")).distinct()
