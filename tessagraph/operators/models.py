"""Trainable models on propagated features with the library's own learners, and their tasks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.feature import Word2Vec
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessagraph.operators import messages as M
from tessagraph.operators.metrics import accuracy, auc


@dataclass(frozen=True)
class Features:
    """How node features are made before a classifier sees them: mean of powers, personalised rounds, sums, or neighbours beside self."""

    kind: str = "powers"
    rounds: int = 2
    alpha: float = 0.1

    def make(self, nodes: DataFrame, edges: DataFrame, dims: int) -> DataFrame:
        """(node, feat) of nodes (node, feat array); nodes without edges keep what the rounds leave of their own."""
        x = M.long(nodes)
        y = {
            "powers": lambda: M.mean_of_powers(x, edges, self.rounds), "personalized": lambda: M.personalized(x, edges, self.rounds, self.alpha), "isomorphism": lambda: M.isomorphism(x, edges),
            "beside": lambda: M.mean_beside_self(x, edges, dims), "attention": lambda: M.attention(x, edges), "none": lambda: x,
        }[self.kind]()
        width = dims * (2 if self.kind == "beside" else 1)
        per = y.groupBy("node").agg(F.map_from_entries(F.collect_list(F.struct("dim", "val"))).alias("m"))
        return per.select("node", F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.coalesce(F.element_at("m", i), F.lit(0.0))).alias("feat"))


def node_classifier(features: DataFrame, labels: DataFrame, train: Column, hidden: tuple[int, ...] = (), seed: int = 7, rounds: int = 50) -> tuple[DataFrame, DataFrame]:
    """(predictions (node, label, prediction), accuracy) of a perceptron, or of logistic regression without hidden layers.

    labels: (node, label, and the columns that `train` reads). Fitted on the training rows; accuracy is over the others.
    """
    x = labels.join(features, "node").select(*labels.columns, array_to_vector("feat").alias("features"), F.col("label").cast("double").alias("y"))
    if hidden:
        size, classes = x.agg(F.max(F.size(vector_to_array("features"))), F.max("y")).first()
        learner = MultilayerPerceptronClassifier(featuresCol="features", labelCol="y", layers=[size, *hidden, int(classes) + 1], seed=seed, maxIter=rounds)
    else:
        learner = LogisticRegression(featuresCol="features", labelCol="y", maxIter=rounds)
    out = learner.fit(x.filter(train)).transform(x)
    rows = out.select(*labels.columns, F.col("prediction").cast("int").alias("prediction"))
    return rows, accuracy(rows.filter(~train))


def weighted_detector(features: DataFrame, labels: DataFrame, train: Column, rounds: int = 50) -> tuple[DataFrame, DataFrame]:
    """(scores (node, label, score), area under the curve) of logistic regression with classes weighted by 1 / their count."""
    x = labels.join(features, "node").select(*labels.columns, array_to_vector("feat").alias("features"), F.col("label").cast("double").alias("y"))
    w = x.filter(train).groupBy("y").agg((1 / F.count("*")).alias("w"))
    fit = LogisticRegression(featuresCol="features", labelCol="y", weightCol="w", maxIter=rounds).fit(x.filter(train).join(F.broadcast(w), "y"))  # one row per class
    s = fit.transform(x).select(*labels.columns, vector_to_array("probability")[1].alias("score"))
    return s, auc(s.filter(~train))


def detector_recall(scores: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(recall): the mean over both classes of the share found at a threshold, of scores (label, score)."""
    hit = (F.col("score") >= threshold).cast("int") == F.col("label")
    return scores.groupBy("label").agg(F.avg(hit.cast("double")).alias("r")).agg(F.avg("r").alias("recall"))


def link_scores(embeddings: DataFrame, pairs: DataFrame) -> DataFrame:
    """pairs (a, b, ...) with `score`: the product of their embeddings (node, feat)."""
    a, b = embeddings.select(F.col("node").alias("a"), F.col("feat").alias("fa")), embeddings.select(F.col("node").alias("b"), F.col("feat").alias("fb"))
    s = F.aggregate(F.zip_with("fa", "fb", lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda p, q: p + q)
    return pairs.join(a, "a").join(b, "b").withColumn("score", s).drop("fa", "fb")


def walk_embeddings(walks: DataFrame, dim: int = 32, window: int = 5, seed: int = 7) -> DataFrame:
    """(node, feat) of skip-grams over walks (path)."""
    m = Word2Vec(inputCol="path", outputCol="v", vectorSize=dim, windowSize=window, minCount=1, seed=seed).fit(walks)
    return m.getVectors().select(F.col("word").alias("node"), vector_to_array("vector").alias("feat"))


def boosted_residuals(table: DataFrame, features: list[str], target: str, edges: DataFrame, cycles: int = 2, trees: int = 5, alpha: float = 0.5) -> DataFrame:
    """(node, prediction): boosted trees on a table's features in turn with the smoothing of their errors along edges.

    Each cycle fits trees to what is left of the target, and adds their prediction mixed with its neighbours' mean.
    """
    from tessagraph.session import checkpoint

    x = table.select("node", F.col(target).cast("double").alias("y"), *features).withColumn("features", array_to_vector(F.array(*[F.col(c).cast("double") for c in features]))).withColumn("p", F.lit(0.0))
    for _ in range(cycles):
        x = checkpoint(x.withColumn("rest", F.col("y") - F.col("p")))
        step = GBTRegressor(featuresCol="features", labelCol="rest", predictionCol="s", maxIter=trees, seed=7).fit(x.filter("rest is not null")).transform(x)
        near = M.aggregate(step.select("node", F.lit(0).alias("dim"), F.col("s").alias("val")), edges, "mean").select("node", F.col("val").alias("n"))
        x = step.join(near, "node", "left").withColumn("p", F.col("p") + (1 - alpha) * F.col("s") + alpha * F.coalesce("n", "s")).drop("rest", "s", "n")
    return x.select("node", F.col("p").alias("prediction"))


def edge_features(edges: DataFrame, dims: int, feat: str = "feat") -> DataFrame:
    """(node, dim, val): the mean of the features of each node's incoming edges (src, dst, feat), for classifiers on edge features."""
    return edges.select(F.col("dst").alias("node"), F.posexplode(F.slice(F.col(feat), 1, dims)).alias("dim", "val")).groupBy("node", "dim").agg(F.avg("val").alias("val"))


def wide(x: DataFrame, key: str, width: int) -> DataFrame:
    """(key, feat): long features (key, dim, val) as arrays; missing dimensions are 0."""
    per = x.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("dim", "val"))).alias("m"))
    return per.select(key, F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.coalesce(F.element_at("m", i), F.lit(0.0))).alias("feat"))


def node_classifier_with_edges(nodes: DataFrame, edges: DataFrame, labels: DataFrame, train: Column, dims: int, edge_dims: int, rounds: int = 1) -> tuple[DataFrame, DataFrame]:
    """`node_classifier` on propagated node features beside the mean features of incoming edges."""
    own = M.mean_of_powers(M.long(nodes), edges, rounds)
    both = own.unionByName(edge_features(edges, edge_dims).withColumn("dim", F.col("dim") + dims))
    return node_classifier(wide(both, "node", dims + edge_dims), labels, train)


def graph_classifier(nodes: DataFrame, edges: DataFrame, graph_of: DataFrame, labels: DataFrame, train: Column, dims: int, how: str = "mean", rounds: int = 1) -> tuple[DataFrame, DataFrame]:
    """(predictions (graph_id, label, prediction), accuracy) on readouts of propagated features; labels: (graph_id, label, ..)."""
    x = M.mean_of_powers(M.long(nodes), edges, rounds)
    feat = wide(M.readout(x, graph_of, how), "graph_id", dims).withColumnRenamed("graph_id", "node")
    rows, score = node_classifier(feat, labels.withColumnRenamed("graph_id", "node"), train)
    return rows.withColumnRenamed("node", "graph_id"), score


def random_propagation(nodes: DataFrame, edges: DataFrame, keep: float, order: int, samples: int = 4, seed: int = 7) -> list[DataFrame]:
    """`samples` feature tables: nodes dropped by hash, the others scaled by 1 / keep, then the mean of powers; for consistency training."""
    out = []
    for i in range(samples):
        stays = F.pmod(F.xxhash64(F.lit(seed + i), "node"), F.lit(1_000_003)) / 1_000_003 < keep
        out.append(M.mean_of_powers(M.long(nodes).withColumn("val", F.when(stays, F.col("val") / keep).otherwise(0.0)), edges, order))
    return out


def consistent_classifier(nodes: DataFrame, edges: DataFrame, labels: DataFrame, train: Column, dims: int, keep: float = 0.5, order: int = 2, samples: int = 4) -> tuple[DataFrame, DataFrame]:
    """`node_classifier` on the mean of randomly propagated features, which the samples must agree on."""
    parts = random_propagation(nodes, edges, keep, order, samples)
    mean = parts[0]
    for p in parts[1:]:
        mean = mean.unionByName(p)
    return node_classifier(wide(mean.groupBy("node", "dim").agg((F.sum("val") / samples).alias("val")), "node", dims), labels, train)


def link_task(embeddings: DataFrame, pairs: DataFrame, ks: tuple[int, ...] = (10, 50, 100)) -> DataFrame:
    """(metric, value) of a link predictor on pairs (a, b, label 0 or 1): the area under the curve and hits at each k."""
    from tessagraph.operators.metrics import hits_at

    s = link_scores(embeddings, pairs)
    out = auc(s).select(F.lit("auc").alias("metric"), F.col("auc").alias("value"))
    for k in ks:
        out = out.unionByName(hits_at(s.filter("label = 1"), s.filter("label = 0"), k).select(F.lit(f"hits_{k}").alias("metric"), F.col("hits").alias("value")))
    return out


def subgraph_link_classifier(counts: DataFrame, train: Column, rounds: int = 50) -> tuple[DataFrame, DataFrame]:
    """(scores (pair, label, score), area under the curve) from label counts (pair, label, z, n, and what `train` reads) of enclosing
    subgraphs: how many of a pair's nodes carry each structural label, up to label 31, is its feature."""
    per = counts.groupBy("pair", F.least("z", F.lit(31)).alias("dim")).agg(F.sum("n").cast("double").alias("val"))
    feat = wide(per.withColumnRenamed("pair", "node"), "node", 32)
    return weighted_detector(feat, counts.drop("z", "n").distinct().withColumnRenamed("pair", "node"), train, rounds)
