"""Reading order over a dependency graph with choices: suppressed options, sequence, neighbours, layout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def suppressed(choices: DataFrame, profile: DataFrame) -> DataFrame:
    """(node): the options that are not read: all but the selected one of each choice, all of a choice left open.

    `choices` has choice_id, options; `profile` has choice_id, selected.
    """
    c = choices.join(profile, "choice_id", "left").select("selected", F.explode("options").alias("node"))
    return c.where("selected is null or node <> selected").select("node").distinct()


def choice_of(choices: DataFrame) -> DataFrame:
    """(node, choice_id): the choice that offers each option, of several the smallest."""
    return choices.select("choice_id", F.explode("options").alias("node")).groupBy("node").agg(F.min("choice_id").alias("choice_id"))


def choice_layers(layers: DataFrame, choices: DataFrame) -> DataFrame:
    """layers (node, layer) in which a choice stands with the first of its options."""
    own = choices.select("choice_id", F.explode("options").alias("node")).join(layers, "node").groupBy(F.col("choice_id").alias("node")).agg(F.min("layer").alias("first"))
    return layers.join(own, "node", "left").select("node", F.coalesce("first", "layer").alias("layer"))


def sequence(layers: DataFrame, hidden: DataFrame) -> DataFrame:
    """(node, layer, previous, following): the nodes that are read, by layer and name, each with its neighbours.

    Neighbours are found within a layer; where layers meet, by the first and last node of each, one row a layer.
    """
    kept = layers.join(hidden, "node", "left_anti")
    w = W.partitionBy("layer").orderBy("node")
    rows = kept.withColumn("p", F.lag("node").over(w)).withColumn("f", F.lead("node").over(w))
    ends = kept.groupBy("layer").agg(F.min("node").alias("first"), F.max("node").alias("last"))
    by = W.orderBy("layer")
    ends = ends.withColumn("before", F.lag("last").over(by)).withColumn("after", F.lead("first").over(by)).select("layer", "before", "after")
    return rows.join(F.broadcast(ends), "layer").select("node", "layer", F.coalesce("p", "before").alias("previous"), F.coalesce("f", "after").alias("following"))


def layout(layers: DataFrame, column: int = 210, row: int = 78, margin: int = 28) -> DataFrame:
    """(node, layer, x, y): columns within a layer by name."""
    at = F.row_number().over(W.partitionBy("layer").orderBy("node")) - 1
    return layers.select("node", "layer", (F.lit(margin) + F.lit(column) * at).alias("x"), (F.lit(margin) + F.lit(row) * F.col("layer")).alias("y"))
