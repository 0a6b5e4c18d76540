"""Connected components of a link table, in Spark."""

from __future__ import annotations

import pyspark.sql.functions as F
from pyspark.sql import DataFrame

from titlepulse.llm.common import cut


def components(links: DataFrame) -> DataFrame:
    """links(a, b) -> (node, comp): comp is the smallest node that links
    reach. Smallest labels pass along links and each label is then replaced
    by its own label, so chains shorten geometrically; every round is written,
    and the loop ends when no label changes."""
    both = links.filter("a <> b").select(F.col("a").alias("u"), F.col("b").alias("v"))
    both = cut(both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "links")
    lab = cut(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("comp")), "labels")
    while True:
        told = (both.join(lab, both["u"] == lab["node"]).groupBy("v").agg(F.min("comp").alias("m")))
        step = (lab.join(told, lab["node"] == told["v"])
                .select("node", F.col("comp").alias("was"), F.least("comp", "m").alias("comp")))
        step = cut(step, "labels-step")
        up = step.select(F.col("node").alias("at"), F.col("comp").alias("next"))
        new = cut(step.join(up, step["comp"] == up["at"], "left")
                  .select("node", "was", F.least("comp", F.coalesce("next", "comp")).alias("comp")), "labels")
        if new.filter("was <> comp").isEmpty():
            return new.select("node", "comp")
        lab = new.select("node", "comp")
