"""A boosted ensemble as rows, and its scores as SQL expressions.

Rows of nodes can be stored, read by any engine and scored there; the text of
a tree is the same in Spark and elsewhere.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions.clock import risk_color, risk_level
from tarmac.operators.features import CATEGORICAL_FEATURES, clip_minutes
from tarmac.operators.lookup import join_lookup
from tarmac.session import work_path

NODE_ROWS = (
    "TREE int, SHARE double, NODE int, FEATURE string, BORDER double, BELOW int, ABOVE int, VALUE double"
)


@dataclass(frozen=True)
class Node:
    """A leaf with a value, or a split: rows up to the border go below, others (and NULL) above."""

    tree: int
    share: float
    node: int
    feature: str | None
    border: float | None
    below: int | None
    above: int | None
    value: float


def tree_nodes(spark: SparkSession, model: PipelineModel) -> list[Node]:
    """All nodes of the ensemble at the end of a pipeline; as many as its rounds and depth allow."""
    assembler, ensemble = model.stages[-2], model.stages[-1]
    names = assembler.getInputCols()
    path = work_path(spark, "ensemble")
    ensemble.write().overwrite().save(path)
    stored = spark.read.parquet(f"{path}/data")
    nodes = []
    for row in stored.select("treeID", "nodeData.*").collect():
        split = row["split"]
        leaf = row["leftChild"] < 0
        nodes.append(
            Node(
                row["treeID"],
                float(ensemble.treeWeights[row["treeID"]]),
                row["id"],
                None if leaf else names[split["featureIndex"]],
                None if leaf else float(split["leftCategoriesOrThreshold"][0]),
                None if leaf else row["leftChild"],
                None if leaf else row["rightChild"],
                float(row["prediction"]),
            )
        )
    return sorted(nodes, key=lambda node: (node.tree, node.node))


def node_table(spark: SparkSession, nodes: Sequence[Node]) -> DataFrame:
    return spark.createDataFrame([tuple(vars(node).values()) for node in nodes], NODE_ROWS)


def margin_text(nodes: Sequence[Node]) -> str:
    """The ensemble's sum as an SQL expression over its features, tree by tree."""
    trees: dict[int, dict[int, Node]] = {}
    for node in nodes:
        trees.setdefault(node.tree, {})[node.node] = node

    def text(tree: dict[int, Node], at: int) -> str:
        node = tree[at]
        if node.feature is None:
            return f"CAST({node.value!r} AS DOUBLE)"
        return f"CASE WHEN {node.feature} <= CAST({node.border!r} AS DOUBLE) THEN {text(tree, node.below)} ELSE {text(tree, node.above)} END"

    parts = [f"CAST({min(tree.values(), key=lambda n: n.node).share!r} AS DOUBLE) * ({text(tree, 0)})" for _, tree in sorted(trees.items())]
    return " + ".join(parts)


def with_means(rows: DataFrame, means: DataFrame, prefix: str) -> DataFrame:
    """Add the stored target mean of every categorical; a value without one takes the feature's overall mean.

    ``means`` holds FEATURE, VALUE and MEAN; the overall mean stands under no VALUE.
    """
    for name in CATEGORICAL_FEATURES:
        own = means.where(F.col("FEATURE") == name)
        overall = own.where("VALUE IS NULL").select("MEAN").first()
        lookup = own.where("VALUE IS NOT NULL").select(F.col("VALUE").alias(name), F.col("MEAN").alias("_mean"))
        rows = join_lookup(rows, lookup, [name])
        filled = F.coalesce("_mean", F.lit(overall[0] if overall else None).cast("double"))
        rows = rows.withColumn(f"{prefix}{name}_mean", filled).drop("_mean")
    return rows


def score(
    rows: DataFrame, classifier: Sequence[Node], regressor: Sequence[Node], class_means: DataFrame, minute_means: DataFrame
) -> DataFrame:
    """Scores of feature rows by stored trees, with the columns of ``delay_model.score``."""
    kept = [F.col(name) for name in rows.columns]
    ready = with_means(with_means(rows, class_means, "clf_"), minute_means, "reg_")
    delay = F.round(1 / (1 + F.exp(-2 * F.expr(margin_text(classifier)))), 4)
    minutes = clip_minutes(F.expr(margin_text(regressor)))
    return ready.select(
        *kept,
        F.round(1 - delay, 4).alias("ON_TIME_PROBABILITY"),
        delay.alias("DELAY_PROBABILITY"),
        F.round(minutes, 1).alias("PREDICTED_DELAY_MIN"),
        F.round(delay * minutes, 1).alias("EXPECTED_DELAY_MIN"),
        risk_level(1 - delay).alias("RISK_LEVEL"),
        risk_color(1 - delay).alias("RISK_COLOR"),
    )


def metrics(scored: DataFrame) -> DataFrame:
    """One row of metrics of scored rows with labels; the area under the curve by rank sums.

    Probabilities have four digits, so ranks are those of ten thousand groups
    at most, whatever the number of rows.
    """
    truth, said = F.col("LABEL_CLASS") == 1, F.col("DELAY_PROBABILITY") >= 0.5
    miss = F.col("PREDICTED_DELAY_MIN") - F.col("LABEL_REG")
    groups = scored.groupBy("DELAY_PROBABILITY").agg(
        F.count_if(truth).alias("pos"),
        F.count(F.lit(1)).alias("n"),
        F.count_if(truth & said).alias("hits"),
        F.count_if(~truth & said).alias("alarms"),
        F.sum(miss * miss).alias("squares"),
        F.sum(F.abs(miss)).alias("misses"),
    )
    ranks = F.aggregate(
        F.array_sort(F.collect_list(F.struct("DELAY_PROBABILITY", "pos", "n"))),
        F.struct(F.lit(0).cast("long").alias("before"), F.lit(0.0).alias("ranks")),
        # rows of one probability share their mean rank
        lambda sums, group: F.struct(
            (sums.before + group.n).alias("before"),
            (sums.ranks + group.pos * (sums.before + (group.n + 1) / 2)).alias("ranks"),
        ),
    )
    total = groups.agg(
        F.sum("n").alias("n"), F.sum("pos").alias("pos"), F.sum("hits").alias("hits"), F.sum("alarms").alias("alarms"),
        F.sum("squares").alias("squares"), F.sum("misses").alias("misses"), ranks["ranks"].alias("ranks"),
    )
    pos, n, hits, alarms = (F.col(name) for name in ("pos", "n", "hits", "alarms"))
    return total.select(
        F.round((n - alarms - (pos - hits)) / n, 6).alias("ACCURACY"),
        F.round(F.coalesce(2 * hits / F.nullif(hits + alarms + pos, F.lit(0)), F.lit(0.0)), 6).alias("F1"),
        F.round((F.col("ranks") - pos * (pos + 1) / 2) / F.nullif(pos * (n - pos), F.lit(0)), 6).alias("AUC_ROC"),
        F.round(F.sqrt(F.col("squares") / n), 4).alias("RMSE"),
        F.round(F.col("misses") / n, 4).alias("MAE"),
        n.alias("ROWS"),
    )
