"""Connected components of links, by hooking and contraction on DataFrames."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def components(links: DataFrame) -> DataFrame:
    """(node, component) for each node of ``links`` (a, b); ``component`` is the smallest node it reaches.

    Every node hooks to its smallest neighbour that is smaller, the hooks are followed to their roots by doubling, and
    the links are contracted to those between different roots, until none is left. Each round is written, so its
    lineage stays short; the driver sees only whether rows are left. Null ends and self-links are ignored.
    """
    links = links.where("a != b").select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct()
    links = staged(links, "links")
    nodes = links.select(F.explode(F.array("lo", "hi")).alias("node")).distinct()
    roots = staged(nodes.select("node", F.col("node").alias("component")), "nodes")
    while not links.isEmpty():
        hooks = staged(links.groupBy("hi").agg(F.min("lo").alias("to")), "hooks")
        while True:
            next_hop = hooks.select(F.col("hi").alias("via"), F.col("to").alias("further"))
            jumped = hooks.join(next_hop, hooks["to"] == next_hop["via"], "left")
            settled = jumped.where("via IS NOT NULL").isEmpty()
            if settled:
                break
            hooks = staged(jumped.select("hi", F.coalesce("further", "to").alias("to")), "hooks")
        roots = staged(
            roots.join(hooks, roots["component"] == hooks["hi"], "left").select("node", F.coalesce("to", "component").alias("component")),
            "roots",
        )
        left = hooks.select(F.col("hi").alias("lo"), F.col("to").alias("new_lo"))
        right = hooks.select("hi", F.col("to").alias("new_hi"))
        ends = links.join(left, "lo", "left").join(right, "hi", "left")
        ends = ends.select(F.coalesce("new_lo", "lo").alias("x"), F.coalesce("new_hi", "hi").alias("y")).where("x != y")
        links = staged(ends.select(F.least("x", "y").alias("lo"), F.greatest("x", "y").alias("hi")).distinct(), "links")
    return roots
