"""Connected components of a link table by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import discard, written


def components(spark: SparkSession, links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(a, b) links -> (node, label), label = smallest node of the component.

    Every round takes the smallest label among the neighbours, then the label of
    the label; rounds grow with the logarithm of the diameter for stars and
    chains alike.  Each round is written to the shared folder.  No links give no
    rows.  Nothing is collected but one count a round.
    """
    edges = written(spark, links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = written(spark, edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("label")), "labels")
    for _ in range(max_rounds):
        near = edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        # hooking: a node also hands the smaller label to the root it points at
        step = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("low"))
        hook = step.groupBy(F.col("label").alias("root")).agg(F.min("low").alias("hooked"))
        step = step.join(hook, step.label == hook.root).select("node", "label", F.least("low", "hooked").alias("low"))
        jump = step.select(F.col("node").alias("low"), F.col("low").alias("jumped"))
        new = step.join(jump, "low", "left").select("node", F.col("label").alias("old"), F.least("low", "jumped").alias("label"))
        new = written(spark, new, "labels")
        changed = new.where("old <> label").limit(1).count()
        discard(spark, labels)
        labels = new.select("node", "label")
        labels.scratch_path = new.scratch_path
        if not changed:
            discard(spark, edges)
            return labels
    raise RuntimeError("components did not settle")
