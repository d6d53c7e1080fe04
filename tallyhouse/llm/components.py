"""Connected components of a graph given by its links, by alternating star contraction.

Each round links the larger neighbours of every node to its smallest neighbour (large star),
then the smaller neighbours likewise (small star), until every node is linked to the smallest
node of its component. A node's arcs are dealt into ``SALTS`` shares by their far ends: minima are
taken by share and then by node, and go back to the shares there are, so the neighbours of a hot node
are spread over as many tasks, which adaptive execution splits further. Each step is a kept table, so a
lost executor costs no earlier round.
"""

from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.scratch import keep


SALTS = 64


def _to_smallest(arcs: DataFrame, kept: Column) -> DataFrame:
    """Links from the far ends of a node's arcs to the smallest of that node's star."""
    arcs = arcs.withColumn("s", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
    shares = arcs.groupBy("u", "s").agg(F.min("v").alias("m"))
    centre = shares.groupBy("u").agg(F.least(F.min("m"), F.col("u")).alias("m"), F.collect_list("s").alias("shares"))
    return arcs.join(centre.select("u", "m", F.explode("shares").alias("s")), ["u", "s"]).where(kept)


def _large_star(links: DataFrame) -> DataFrame:
    arcs = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    far = _to_smallest(arcs, F.col("v") > F.col("u"))
    return far.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """``links`` run from the larger to the smaller node."""
    far = _to_smallest(links, F.lit(True))
    ends = far.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
    return ends.where(F.col("u") != F.col("v")).distinct()


def _digest(links: DataFrame) -> tuple[int, int]:
    hashed = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    row = links.agg(F.count(F.lit(1)).alias("n"), hashed.alias("h")).first()
    return row["n"], row["h"]


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every linked node but the roots; ``links`` has columns u and v.

    Links of a node to itself, repeated links and links with a NULL end change nothing.
    """
    u, v = F.col("u"), F.col("v")
    links = links.where(u != v).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"))
    links = keep(links.distinct(), "links")
    before = _digest(links)
    while before[0]:
        larger = keep(_large_star(links), "large-star")
        links = keep(_small_star(larger), "small-star")
        after = _digest(links)
        if after == before:
            break
        before = after
    return links.select(u.alias("node"), v.alias("root"))
