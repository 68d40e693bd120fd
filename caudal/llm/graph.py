"""Connected components of links between long ids, by alternating large-star and small-star steps.

Each step is two shuffles of the links that are left; their number falls to one
link for each node. Steps are written to the shared folder, so lineage stays
short. Nothing but two numbers for each step reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialise


def components(links: DataFrame, most_rounds: int = 64) -> DataFrame:
    """(node, comp) for each node of links (a, b) that has a link to another; comp is the smallest node reachable.

    Links to oneself and links with a null end are ignored; the direction and repeats of links do not matter.
    """
    a, b = F.col("a"), F.col("b")
    e = links.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    e = materialise(e, "links")
    before = None
    for _ in range(most_rounds):
        both = e.union(e.select(b.alias("a"), a.alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where(b > a).select(b.alias("a"), F.col("m").alias("b"))
        large = materialise(large.distinct(), "large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct(b.alias("a"), F.col("m").alias("b")), F.struct(a.alias("a"), F.col("m").alias("b")))).alias("x")).select("x.*")
        new = materialise(small.where(a != b).distinct(), "small")
        for old in (e, large):
            discard(old)
        e = new
        r = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if (r.n, r.h) == before:
            break
        before = (r.n, r.h)
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return e.groupBy("a").agg(F.min("b").alias("comp")).select(F.col("a").alias("node"), "comp")
