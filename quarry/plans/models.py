"""The model bundle: fit once, save, load, and predict every profile.

The decision tree is an MLlib pipeline, the forest a table of trees, the neighbour model is its training matrix
(vectors in the train-fitted space) with labels.  A bundle is a folder that any
session can load; what it holds is checked, and a missing one is an error.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from quarry import config as C
from quarry.functions.numeric import round_half_even
from quarry.functions.text import safe_text
from quarry.operators import evaluate as EV
from quarry.operators import features as FT
from quarry.operators.forest import Forest
from quarry.operators.knn import predict_from_votes, vote
from quarry.operators.metric import nearest
from quarry.session import hand_off

TREES = ("decision_tree", "random_forest")
MODELS = (*TREES, "knn")
NUM = C.NUMERIC_FEATURES
#: What the bundle keeps of a historical student beside id, vector and track.
HISTORY = ["gpa", "interest", "failed_courses", *C.GRADE_COLS]


class MissingBundleError(FileNotFoundError):
    pass


# -- neighbour model ----------------------------------------------------------
def space_of(df: DataFrame, fit: DataFrame) -> DataFrame:
    """``df`` with ``vec``: numerics standardised by ``fit`` and the interest
    as one column per valid interest."""
    cats = FT.interest_categories()
    out = FT.one_hot(FT.standardize(df, NUM, fit=fit), "interest", cats, prefix="oh_")
    vec = F.array(*[F.col("z_" + c) for c in NUM], *[F.col("oh_" + v) for v in cats])
    return out.withColumn("vec", vec)


def knn_votes(queries: DataFrame, history: DataFrame) -> DataFrame:
    """Distance-weighted votes; queries (qid, vec), history (hid, vec, label)."""
    return vote(nearest(queries, history, C.KNN_K), history.select("hid", "label"))


# -- trees ----------------------------------------------------------------------
def tree_scores(model: PipelineModel | Forest, df: DataFrame) -> DataFrame:
    """student_id, predicted and confidence (largest class probability)."""
    return EV.scored(model, df).select("student_id", "predicted", "confidence")


# -- bundle ---------------------------------------------------------------------
def save_models(split: DataFrame, rules: DataFrame, path: str) -> None:
    """Fit the three models on the train rows of ``split`` and write them with
    their test metrics, confusion tables, importances and rules below ``path``."""
    spark = split.sparkSession
    train, test = split.filter(~F.col("is_test")), split.filter(F.col("is_test"))
    # the training matrix, and beside it all historical rows in the same space
    matrix = space_of(split, train)
    matrix.select(F.col("row_order").alias("hid"), "vec", F.col(C.TARGET).alias("label"), "is_test", "student_id", *HISTORY).write.mode("overwrite").parquet(f"{path}/history")
    stats = train.agg(*[x for c in NUM for x in (F.avg(F.col(c).cast("double")).alias(f"m__{c}"), F.stddev_pop(F.col(c).cast("double")).alias(f"s__{c}"))])
    stats.write.mode("overwrite").parquet(f"{path}/scaler")
    for kind in TREES:
        EV.save_tree(EV.fit_tree(split, kind), f"{path}/{kind}")
    models = load_models(spark, path, complete=False)
    facts = test.select("student_id", F.col(C.TARGET).alias("actual"))
    scored = predict_all(models, test).join(facts, "student_id")
    scored.write.mode("overwrite").parquet(f"{path}/test_predictions")
    scored = spark.read.parquet(f"{path}/test_predictions")
    metrics = scored.groupBy("model").agg(round_half_even(F.avg((F.col("predicted") == F.col("actual")).cast("double")) * 100.0, 2).alias("accuracy_pct"))
    metrics.write.mode("overwrite").parquet(f"{path}/metrics")
    scored.groupBy("model", "actual", "predicted").agg(F.count(F.lit(1)).alias("count")).write.mode("overwrite").parquet(f"{path}/confusion")
    EV.importance_of(models["random_forest"]).write.mode("overwrite").parquet(f"{path}/importance")
    rules.write.mode("overwrite").parquet(f"{path}/rules")


def load_models(spark: SparkSession, path: str, complete: bool = True) -> dict:
    """The models and tables of a saved bundle."""
    try:
        tables = ("history", "scaler", *(("metrics", "confusion", "importance", "rules", "test_predictions") if complete else ()))
        out: dict = {k: spark.read.parquet(f"{path}/{k}") for k in tables}
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        raise MissingBundleError(f"no complete model bundle at '{path}'") from e
    out |= {k: EV.load_tree(spark, k, f"{path}/{k}") for k in TREES}
    out["knn"] = out["history"].filter(~F.col("is_test")).select("hid", "vec", "label")
    return out


def profile_vectors(models: dict, profiles: DataFrame) -> DataFrame:
    """Profiles in the space of the training matrix: qid, vec."""
    stats = models["scaler"].select(F.struct("*").alias("st")).scalar()
    rows = profiles.withColumn("_st", stats)
    zs = []
    for c in NUM:
        s = F.col("_st")[f"s__{c}"]
        zs.append((F.col(c).cast("double") - F.col("_st")[f"m__{c}"]) / F.when(s.isNull() | (s < 1e-12), F.lit(1.0)).otherwise(s))
    vec = F.array(*zs, *[(F.col("interest") == F.lit(v)).cast("double") for v in FT.interest_categories()])
    return rows.select(F.col("row_order").alias("qid"), vec.alias("vec"))


def predict_all(models: dict, profiles: DataFrame) -> DataFrame:
    """Every profile through every model: model, student_id, predicted,
    confidence (share of the vote or class probability).  Each model's answers
    are written, so no plan holds two models and none is asked twice."""
    votes = knn_votes(hand_off(profile_vectors(models, profiles), "profile-vectors"), models["knn"])
    near = predict_from_votes(votes).join(profiles.select(F.col("row_order").alias("qid"), "student_id"), "qid")
    out = hand_off(near.select(F.lit("knn").alias("model"), "student_id", "predicted", "confidence"), "answers")
    for kind in TREES:
        out = out.unionByName(hand_off(tree_scores(models[kind], profiles).withColumn("model", F.lit(kind)), "answers"))
    return out


def compare(models: dict, profiles: DataFrame) -> DataFrame:
    """One row per profile and model; ``agrees``: with the model that the
    profile's ``algorithm`` names."""
    scored = predict_all(models, profiles)
    chosen = (profiles.select("student_id", F.col("algorithm").alias("model"))
              .join(scored.select("student_id", "model", F.col("predicted").alias("chosen_track")), ["student_id", "model"])
              .select("student_id", "chosen_track"))
    label = F.create_map(*[F.lit(x) for kv in C.ALGORITHM_LABELS.items() for x in kv])
    return (scored.join(chosen, "student_id").join(models["metrics"], "model")   # one row per model
            .select("student_id", "model", label[F.col("model")].alias("algorithm"), F.col("predicted").alias("track"),
                    round_half_even(F.col("confidence") * 100.0, 1).alias("confidence"),
                    (F.col("predicted") == F.col("chosen_track")).alias("agrees"), F.col("accuracy_pct").alias("accuracy")))


def similar_students(models: dict, profiles: DataFrame, limit: int = C.SIMILAR_STUDENTS) -> DataFrame:
    """The nearest historical students of every profile, from a loaded bundle:
    student_id, rank, neighbour_id, gpa, interest, track, failed_courses, similarity."""
    near = hand_off(nearest(hand_off(profile_vectors(models, profiles), "profile-vectors"), models["history"].select("hid", "vec"), limit), "similar")
    last = F.max("dist").over(Window.partitionBy("qid"))
    similarity = round_half_even(F.greatest(F.lit(0.0), 100.0 - F.col("dist") / F.greatest(last, F.lit(0.001)) * 25.0), 1)
    held = models["history"].select("hid", safe_text("student_id", "Unknown").alias("neighbour_id"), round_half_even("gpa", 2).alias("gpa"), safe_text("interest", "Undecided").alias("interest"),
                                    safe_text("label", "Unknown").alias("track"), safe_text("failed_courses").alias("failed_courses"))
    return (near.withColumn("similarity", similarity).join(held, "hid").join(profiles.select(F.col("row_order").alias("qid"), "student_id"), "qid")
            .select("student_id", "rank", "neighbour_id", "gpa", "interest", "track", "failed_courses", "similarity"))


# -- cross-validation -------------------------------------------------------------
def cross_validate_knn(folds: DataFrame) -> DataFrame:
    """k-fold accuracy of the neighbour model, all folds in one job: every row
    is put into each fold's space, where it is a query or history.  The folds'
    statistics are broadcast: a shuffle by fold would leave a task for each fold."""
    n = F.array(*[F.lit(f) for f in range(C.CV_FOLDS)])
    each = folds.select("row_order", "fold", "interest", C.TARGET, *[F.col(c).cast("double").alias(c) for c in NUM], F.explode(n).alias("part"))
    stats = each.filter(F.col("fold") != F.col("part")).groupBy("part").agg(
        *[x for c in NUM for x in (F.avg(c).alias(f"m__{c}"), F.stddev_pop(c).alias(f"s__{c}"))])
    stats = hand_off(stats, "cv-scaler")   # one row per fold, which the search's jobs read again
    zs = [(F.col(c) - F.col(f"m__{c}")) / F.when(F.col(f"s__{c}").isNull() | (F.col(f"s__{c}") < 1e-12), F.lit(1.0)).otherwise(F.col(f"s__{c}")) for c in NUM]
    vec = F.array(*zs, *[(F.col("interest") == F.lit(v)).cast("double") for v in FT.interest_categories()])
    space = each.join(F.broadcast(stats), "part").select("part", "fold", F.col("row_order").alias("id"), F.col(C.TARGET).alias("label"), vec.alias("vec"))
    q = space.filter(F.col("fold") == F.col("part")).withColumnRenamed("id", "qid")
    h = space.filter(F.col("fold") != F.col("part")).withColumnRenamed("id", "hid")
    facts = folds.select(F.col("row_order").alias("hid"), F.col(C.TARGET).alias("label"))
    votes = vote(nearest(q, h, C.KNN_K, part="part"), facts)
    right = predict_from_votes(votes).join(folds.select(F.col("row_order").alias("qid"), "fold", C.TARGET), "qid")
    per = hand_off(right.groupBy("fold").agg(F.avg((F.col("predicted") == F.col(C.TARGET)).cast("double")).alias("acc")), "cv")
    whole = per.agg(F.struct(round_half_even(F.avg("acc") * 100.0, 2).alias("mean"), round_half_even(F.stddev_pop("acc") * 100.0, 2).alias("std"))).scalar()
    return (per.withColumn("_cv", whole)
            .select("fold", F.round(F.col("acc") * 100.0, 2).alias("accuracy_pct"), F.col("_cv.mean").alias("cv_mean"), F.col("_cv.std").alias("cv_std")))


def cross_validate_trees(folds: DataFrame) -> DataFrame:
    """k-fold accuracy of the trees on the same folds: a row for each model and
    fold with the model's mean and std.  A fold's model is fitted, its
    predictions are written, and it is dropped; nothing of the folds stays on
    the driver.  The two kinds are fitted side by side, since the decision
    tree's many short jobs leave most cores idle."""
    def scores(kind: str) -> DataFrame:
        out = []
        for f in range(C.CV_FOLDS):
            model = EV.fit_rows(folds.filter(F.col("fold") != f), kind)
            held = folds.filter(F.col("fold") == f)
            out.append(hand_off(tree_scores(model, held).join(held.select("student_id", C.TARGET), "student_id")
                                .select(F.lit(kind).alias("model"), F.lit(f).alias("fold"), (F.col("predicted") == F.col(C.TARGET)).cast("double").alias("right")), "cv"))
        return reduce(DataFrame.unionByName, out)

    with ThreadPoolExecutor(len(TREES)) as pool:
        scored = reduce(DataFrame.unionByName, pool.map(inheritable_thread_target(folds.sparkSession)(scores), TREES))
    per = scored.groupBy("model", "fold").agg(F.avg("right").alias("acc"))
    whole = per.groupBy("model").agg(round_half_even(F.avg("acc") * 100.0, 2).alias("cv_mean"), round_half_even(F.stddev_pop("acc") * 100.0, 2).alias("cv_std"))
    return per.join(whole, "model").select("model", "fold", F.round(F.col("acc") * 100.0, 2).alias("accuracy_pct"), "cv_mean", "cv_std")   # a few rows


# -- model cards ------------------------------------------------------------------
def model_cards(scored: DataFrame, cv: DataFrame, importance: DataFrame | None = None) -> DataFrame:
    """What the dashboard shows of each model, a row for each figure: model,
    figure, item, value.  ``scored``: model, actual, predicted of the test
    rows; ``cv``: model, cv_mean, cv_std; ``importance``: of the forest."""
    cells = scored.groupBy("model", "actual", "predicted").agg(F.count(F.lit(1)).alias("n"))
    labels = F.array(*[F.lit(x) for x in sorted(C.TRACK_NAMES)])
    names = scored.select("model").distinct()
    dense = (names.select("model", F.explode(labels).alias("actual")).select("model", "actual", F.explode(labels).alias("predicted"))
             .join(cells, ["model", "actual", "predicted"], "left").withColumn("n", F.coalesce("n", F.lit(0)).cast("double")))
    right = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(F.lit(0.0))
    accuracy = cells.groupBy("model").agg(round_half_even(F.sum(right) / F.sum("n") * 100.0, 2).alias("value")).select("model", F.lit("accuracy").alias("figure"), F.lit("").alias("item"), "value")
    # a class as the actual one, and as the predicted one
    sides = [dense.groupBy("model", F.col(c).alias("item")).agg(F.sum("n").alias(name), F.sum(right).alias("right")) for c, name in (("actual", "support"), ("predicted", "given"))]
    per = sides[0].join(sides[1].drop("right"), ["model", "item"])
    share = lambda x, y: F.when(y > 0, x / y).otherwise(F.lit(0.0))
    per = per.withColumn("precision", share(F.col("right"), F.col("given"))).withColumn("recall", share(F.col("right"), F.col("support")))
    both = F.col("precision") + F.col("recall")
    per = per.withColumn("f1", share(2 * F.col("precision") * F.col("recall"), both))
    report = per.unpivot(["model", "item"], ["precision", "recall", "f1", "support"], "figure", "value")
    confusion = dense.select("model", F.lit("confusion").alias("figure"), F.concat_ws(" > ", "actual", "predicted").alias("item"), F.col("n").alias("value"))
    validated = cv.select("model", "cv_mean", "cv_std").distinct().unpivot(["model"], ["cv_mean", "cv_std"], "figure", "value").select("model", "figure", F.lit("").alias("item"), "value")
    out = accuracy.unionByName(report.select("model", "figure", "item", "value")).unionByName(confusion).unionByName(validated)
    if importance is not None:
        out = out.unionByName(importance.select(F.lit("random_forest").alias("model"), F.lit("importance").alias("figure"), F.col("group").alias("item"), F.col("importance").alias("value")))
    return out.select("model", "figure", "item", F.round("value", 6).alias("value"))
