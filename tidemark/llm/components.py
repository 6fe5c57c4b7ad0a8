"""Connected components of a graph given by its edges, without collecting it anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import noting, removed, saved


def components(edges: DataFrame) -> DataFrame:
    """node and root, the smallest node reachable, of every node in edges (a, b).

    Each round gives every node the smallest root among its own and its neighbours', then replaces roots by
    their roots' roots. Sums and joins only, with map-side combine, so a hub of any degree spreads; each round is
    cut in the shared folder, and the one before is removed.
    """
    both = saved(
        edges.select("a", "b").where("a != b").unionByName(edges.where("a != b").select(F.col("b").alias("a"), F.col("a").alias("b")))
        .distinct()
    )
    with noting() as old:
        roots = saved(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near")).select("node", F.least("node", "near").alias("root")))
    while True:
        heard = (
            both.join(roots.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node"))
            .agg(F.min("root").alias("heard"))
        )
        lower = roots.join(heard, "node").select("node", F.least("root", "heard").alias("next"), "root")
        jump = lower.select(F.col("node").alias("next"), F.col("next").alias("far"))
        with noting() as new:
            after = saved(
                lower.join(jump, "next", "left")
                .select("node", F.least("next", F.coalesce("far", "next")).alias("next"), "root")
            )
        removed(edges.sparkSession, old)
        old = new
        changed = not after.where("next != root").isEmpty()
        roots = after.select("node", F.col("next").alias("root"))
        if not changed:
            return roots
