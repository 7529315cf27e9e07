"""Random-forest scores, one model per user type and age in months.

A registry of forests is a table of tree nodes. A repository walks the trees of its own cohort by expressions on its
row, so all cohorts are scored in one scan, by any engine that has the nodes.
"""

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repopulse.session import cut_lineage, shared_path

# --- Fixed values ---------------------------------------------------------------------------
USER_TYPES = ["User", "Organization"]
MODEL_MONTHS = range(1, 19)
# -------------------------------------------------------------------------------------------

Models = dict[tuple[str, int], RandomForestClassificationModel]


def cohorts(vectors: DataFrame) -> list[tuple[str, int]]:
    """The (user type, age) pairs present: at most 36, the size of the model registry."""
    known = vectors.filter(F.col("user_type").isin(USER_TYPES)
                           & F.col("max_month").between(MODEL_MONTHS[0], MODEL_MONTHS[-1]))
    return [(r.user_type, r.max_month)
            for r in known.select("user_type", "max_month").distinct().sort("user_type", "max_month").collect()]


def _cohort(df: DataFrame, user_type: str, month: int) -> DataFrame:
    return df.filter((F.col("user_type") == user_type) & (F.col("max_month") == month))


def fit_cohort_models(labelled: DataFrame, label: str = "label", trees: int = 20, depth: int = 5,
                      seed: int = 7) -> Models:
    """Train the registry from vectors with a 0/1 ``label`` column supplied by the caller."""
    data = cut_lineage(labelled.withColumn("vector", array_to_vector("features")))
    forest = RandomForestClassifier(featuresCol="vector", labelCol=label, numTrees=trees,
                                    maxDepth=depth, seed=seed)
    return {cohort: forest.fit(_cohort(data, *cohort)) for cohort in cohorts(data)}


def save_models(models: Models, path: str) -> None:
    for (user_type, month), model in models.items():
        model.write().overwrite().save(f"{path}/{user_type}/{month}")


def load_models(path: str, wanted: list[tuple[str, int]]) -> Models:
    return {(u, m): RandomForestClassificationModel.load(f"{path}/{u}/{m}") for u, m in wanted}


#: One row a node. ``node`` counts from 0, the root, without gaps in a tree; a leaf has no feature and the share of
#: class 1 as its score, any other node goes on with ``low`` where the feature is at most the threshold, else with
#: ``high``; children have greater numbers than their parent.
NODES = "user_type string, month int, tree int, node int, feature int, threshold double, low int, high int, score double"


def forest_nodes(spark: SparkSession, models: Models) -> DataFrame:
    """The nodes of fitted models, read from the form in which Spark ML saves them."""
    path, empty = shared_path(spark, "forests"), spark.createDataFrame([], NODES)
    save_models(models, path)
    nodes = empty
    for user_type, month in models:
        data = spark.read.parquet(f"{path}/{user_type}/{month}/data").select("treeID", "nodeData.*")
        if not data.filter(F.col("split.numCategories") >= 0).isEmpty():
            raise ValueError("the walk compares numbers; categories are not supported")
        stats, leaf = F.col("impurityStats"), F.col("leftChild") < 0
        total = F.aggregate(stats, F.lit(0.0), lambda a, x: a + x)
        nodes = nodes.unionByName(data.select(
            F.lit(user_type).alias("user_type"), F.lit(month).alias("month"), F.col("treeID").alias("tree"), F.col("id").alias("node"),
            F.when(~leaf, F.col("split.featureIndex")).alias("feature"), F.when(~leaf, F.get("split.leftCategoriesOrThreshold", F.lit(0))).alias("threshold"),
            F.when(~leaf, F.col("leftChild")).alias("low"), F.when(~leaf, F.col("rightChild")).alias("high"),
            F.when(leaf, F.try_divide(F.get(stats, F.lit(1)), total)).alias("score")))
    return nodes


def forests(nodes: DataFrame) -> DataFrame:
    """One row a cohort: its trees, each as arrays by node, and the length of the longest walk."""
    node = F.struct("node", "feature", "threshold", "low", "high", "score")
    trees = nodes.groupBy("user_type", "month", "tree").agg(F.array_sort(F.collect_list(node)).alias("nodes"))
    levels = F.aggregate("nodes", F.array_repeat(F.lit(0), F.size("nodes")), lambda levels, x: F.transform(
        levels, lambda level, i: F.when((i == x["low"]) | (i == x["high"]), F.get(levels, x["node"]) + 1).otherwise(level)))
    return trees.withColumn("steps", F.array_max(levels)).groupBy("user_type", "month").agg(
        F.array_sort(F.collect_list(F.struct("tree", "nodes")))["nodes"].alias("trees"), F.max("steps").alias("steps"))


def walked(nodes: Column, features: Column, steps: Column) -> Column:
    """The score of the leaf that a vector reaches in one tree. A missing value goes the high way."""
    def step(at: Column, _: Column) -> Column:
        here = F.get(nodes, at)
        goes_low = F.coalesce(F.get(features, here["feature"]) <= here["threshold"], F.lit(False))
        return F.when(here["feature"].isNull(), at).otherwise(F.when(goes_low, here["low"]).otherwise(here["high"]))

    return F.get(nodes, F.aggregate(F.array_repeat(F.lit(0), steps), F.lit(0), step))["score"]


def score_by_nodes(vectors: DataFrame, nodes: DataFrame) -> DataFrame:
    """Mean score over the trees of each repository's own cohort; NULL without a forest. Leaves that saw no row have no
    score and don't count.

    The table of forests is broadcast: its size is that of the registry, 36 cohorts, and not of the data.
    """
    table = forests(nodes).withColumnsRenamed({"user_type": "_type", "month": "_month"})
    joined = vectors.join(F.broadcast(table), (F.col("user_type") == F.col("_type")) & (F.col("max_month") == F.col("_month")), "left")
    scores = F.transform("trees", lambda tree: walked(tree, F.col("features"), F.col("steps")))
    known = F.filter(scores, lambda x: x.isNotNull())
    mean = F.try_divide(F.aggregate(known, F.lit(0.0), lambda a, x: a + x), F.size(known))
    return joined.select(F.when(F.col("trees").isNotNull(), mean).alias("model_score"), "repo_owner", "repo_name", "user_type", "repo_created_at",
                         F.col("max_month").alias("age_of_project"))


def score_repositories(vectors: DataFrame, models: Models) -> DataFrame:
    """Probability of class 1 from the model of each repository's own cohort; NULL without a model."""
    nodes = cut_lineage(forest_nodes(vectors.sparkSession, models), "tree_nodes") if models else vectors.sparkSession.createDataFrame([], NODES)
    return score_by_nodes(vectors, nodes)
