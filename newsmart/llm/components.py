"""Connected components by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from newsmart.llm.common import stored

#: Each round leaves half of the vertices or fewer in expectation, as ids are hashes.
MAX_ROUNDS = 100


def components(links: DataFrame) -> DataFrame:
    """id, root for every end of ``links`` (u, v); a root is one of its component's ids.

    Every vertex moves to its least neighbour or itself, links follow and loops
    fall away, until none is left.  A vertex with a third of all links is one row
    per task in the grouped minimum.  Ids should be hashes, so that long chains
    break in the middle.  The driver sees only whether links are left.
    """
    links = stored(links.select("u", "v").where("u != v").distinct(), "links")
    ends = links.select(F.col("u").alias("id")).union(links.select("v")).distinct()
    roots = stored(ends.withColumn("root", F.col("id")), "roots")
    for _ in range(MAX_ROUNDS):
        if not links.head(1):
            return roots
        both = links.union(links.select("v", "u"))
        moves = stored(
            both.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("to")), "moves"
        )
        links = stored(
            links.join(moves, "u")
            .select(F.col("to").alias("u"), "v")
            .join(moves.select(F.col("u").alias("v"), F.col("to").alias("w")), "v")
            .select("u", F.col("w").alias("v"))
            .where("u != v")
            .distinct(),
            "links",
        )
        roots = stored(
            roots.join(moves.select(F.col("u").alias("root"), "to"), "root", "left").select(
                "id", F.coalesce("to", "root").alias("root")
            ),
            "roots",
        )
    raise ValueError("links did not settle")
