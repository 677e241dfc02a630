"""Connected components of a graph given as links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.session import cut_all


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for all nodes of links (a, b); component is the smallest node that is reachable.

    Each round gives every node the smallest label among its neighbours and itself, then that label's own label
    (pointer jumping), until nothing changes. No round keeps the size estimates of the last one, which would multiply. A node with very many neighbours is met by partial aggregation. Links
    with a null end are left out; no table is collected.
    """
    links = links.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    arcs = cut_all(links.select(F.col(a).alias("n"), F.col(b).alias("m")).union(links.select(b, a)).distinct())
    labels = cut_all(arcs.groupBy("n").agg(F.least(F.col("n"), F.min("m")).alias("label")))
    while True:
        heard = arcs.join(labels.select(F.col("n").alias("m"), "label"), "m").groupBy("n").agg(F.min("label").alias("heard"))
        stepped = labels.join(heard, "n").select("n", F.least("label", "heard").alias("new"), F.col("label").alias("old"))
        jumped = cut_all(stepped.join(labels.select(F.col("n").alias("new"), F.col("label").alias("far")), "new").select("n", F.least("new", "far").alias("label"), "old"))
        if jumped.filter("label <> old").isEmpty():
            return labels.select(F.col("n").alias("node"), F.col("label").alias("component"))
        labels = jumped.select("n", "label")
