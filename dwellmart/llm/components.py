"""Connected components of a link table, by alternating large-star and small-star steps.

Each step replaces links by links to smaller nodes and is a partial aggregation plus one join, so a node
with a third of all links is one row of the aggregate; AQE splits its part of the join. The links of each
step are a table in the shared folder: a lost executor costs a part of one step. The number of steps
follows the logarithm of the longest chain, not its length.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellmart.llm.stored import stored, temporary


def component_of(links: DataFrame) -> DataFrame:
    """Links (a, b) of longs -> (node, component): the smallest node each linked node can reach.

    Links may repeat and run either way. NULL ends and links of a node to itself are left out; nodes with
    no link to another do not appear. No links give no rows.
    """
    current = stored(
        links.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(),
        "links",
    )
    mark = None
    while True:
        both = current.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(current.select("lo", "hi"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        with temporary(links.sparkSession) as keep:
            large = stored(
                both.where("v > u").join(low, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct(),
                "links",
            )
            low = large.groupBy("hi").agg(F.min("lo").alias("m"))
            small = large.join(low, "hi").where("lo > m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
            current = keep(small.union(low.select("hi", "m")).distinct(), "links")
        before, mark = mark, current.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first()
        if before == mark:
            break
    roots = current.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return current.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(roots)
