"""Connected components of links, by least labels and pointer jumping over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(a, b) pairs → (node, root): the least node of every linked node's component. Every
    round takes the least label among neighbours, then the label's own label; a chain of n
    links ends in about log n rounds."""
    spark = links.sparkSession
    edges = written(spark, links.select("a", "b").union(links.select("b", "a")).distinct(), "cc-edges")
    state = written(spark, edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("root")), "cc-state")
    while True:
        near = edges.join(state, edges["a"] == state["node"]).groupBy(F.col("b").alias("node")).agg(F.min("root").alias("seen"))
        least = written(spark, state.join(near, "node").select("node", F.col("root").alias("was"), F.least("root", "seen").alias("root")), "cc-least")
        up = least.select(F.col("node").alias("root"), F.col("root").alias("top"))
        state = written(spark, least.join(up, "root").select("node", F.least("root", "top").alias("root"), "was"), "cc-state")
        if not state.filter("root <> was").limit(1).count():
            return state.select("node", "root")
        state = state.select("node", "root")
