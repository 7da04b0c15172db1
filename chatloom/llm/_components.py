"""Connected components of links, by hooking to the smallest neighbour and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import cut


def components(links: DataFrame) -> DataFrame:
    """(a, b) links to (id, comp): comp is the smallest id reachable. Each round is joins and aggregates over links and
    ids, written to the shared folder; the number of rounds grows with the logarithm of the longest chain."""
    both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b")
    edges = cut(both)
    label = cut(edges.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("comp")))
    while True:
        near = edges.join(label.select(F.col("id").alias("b"), F.col("comp").alias("c")), "b").groupBy(F.col("a").alias("id")).agg(F.min("c").alias("c"))
        hooked = label.join(near, "id").select("id", F.col("comp").alias("was"), F.least("comp", "c").alias("comp"))
        jump = hooked.select(F.col("id").alias("comp"), F.col("comp").alias("next"))
        label_new = cut(hooked.join(jump, "comp", "left").select("id", "was", F.least(F.col("comp"), F.coalesce("next", "comp")).alias("comp")))
        label = label_new.select("id", "comp")
        if label_new.filter("comp <> was").isEmpty():
            return label
