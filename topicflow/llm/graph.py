"""Connected components by alternating stars, each round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicflow.llm.common import stored

#: Rounds after which an unfinished run fails instead of running on; a round shortens paths by
#: half or more, so this is beyond any real table.
MAX_ROUNDS = 60


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("src", "dst").union(edges.select("dst", "src"))


def _stars(pairs: DataFrame, larger_only: bool) -> DataFrame:
    """Connects neighbours of each node (``src``) with the smallest among them and the node.

    The smallest neighbour is a partial aggregate. It is written before it is joined back, so that the
    join has a shuffle on both sides, which Spark can split: a hub with very many neighbours is no
    single task.
    """
    lowest = stored(pairs.groupBy("src").agg(F.min("dst").alias("m")))
    root = F.least("src", "m")
    joined = pairs.join(lowest, "src")
    if larger_only:
        out = joined.where(F.col("dst") > F.col("src")).select(F.col("dst").alias("src"), root.alias("dst"))
    else:
        out = joined.select(F.col("dst").alias("src"), root.alias("dst")).union(
            lowest.select("src", root.alias("dst"))
        )
    return out.where(F.col("src") != F.col("dst")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (``src, dst``): its smallest reachable node.

    Loops and repeated edges do no harm; null ends are dropped. Rounds of a large and a small star
    run until the edges no longer change, when every node points at its component. An empty table
    gives no rows.
    """
    clean = edges.where("src is not null and dst is not null and src <> dst")
    now = stored(
        clean.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct()
    )
    before = None
    for _ in range(MAX_ROUNDS):
        large = _stars(_both(now), larger_only=True)
        small = stored(_stars(large, larger_only=False))
        mark = small.agg(
            F.count(F.lit(1)), F.bit_xor(F.xxhash64("src", "dst")), F.sum(F.xxhash64("src", "dst") % 1000003)
        ).first()
        now = small
        if mark == before:
            break
        before = mark
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = now.select(F.col("dst").alias("node"), F.col("dst").alias("component")).distinct()
    return now.select(F.col("src").alias("node"), F.col("dst").alias("component")).union(roots)
