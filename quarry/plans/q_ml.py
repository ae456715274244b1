"""Query keys for encoding, splitting, kNN models, evaluation and trees."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry import config as C
from quarry.functions.numeric import round_half_even
from quarry.functions.text import safe_text
from quarry.operators import evaluate as EV
from quarry.operators import features as FT
from quarry.operators.knn import predict_from_votes, vote
from quarry.operators.lsh import approx_nearest, recall
from quarry.operators.metric import Search, nearest
from quarry.plans import models as M
from quarry.plans.catalog import register
from quarry.plans.derived import materialize, sl, store_path
from quarry.plans.q_rules import saved_target_rules
from quarry.sources.tables import read_table

NUM = C.NUMERIC_FEATURES


def split_students(spark, sf) -> DataFrame:
    return materialize(spark, "split", sf, lambda: FT.stratified_split(sl(spark, sf), C.TARGET))


def train_space(spark, sf) -> DataFrame:
    """Feature vectors of every labelled row in the train-fitted space,
    written once (like the original's saved training matrix)."""
    def build():
        data = split_students(spark, sf)
        return M.space_of(data, data.filter(~F.col("is_test"))).select("row_order", "is_test", "vec")
    return materialize(spark, "train_space", sf, build)


def knn_test_predictions(spark, sf, fresh: bool = False) -> DataFrame:
    """KNN (k=9, distance weights) trained on the split's train rows,
    predicting the test rows: qid, student_id, actual, predicted, confidence
    and the per-class vote shares.  Written once for the evaluation keys;
    ``fresh=True`` recomputes the search (used by ``knn_classify``)."""
    def build():
        data = split_students(spark, sf)
        space = train_space(spark, sf)
        q = space.filter(F.col("is_test")).select(F.col("row_order").alias("qid"), "vec")
        h = space.filter(~F.col("is_test")).select(F.col("row_order").alias("hid"), "vec")
        nn = nearest(q, h, C.KNN_K)
        votes = vote(nn, data.select(F.col("row_order").alias("hid"), F.col(C.TARGET).alias("label")))
        pred = predict_from_votes(votes)
        facts = data.filter(F.col("is_test")).select(F.col("row_order").alias("qid"), "student_id",
                                                      F.col(C.TARGET).alias("actual"))
        probs = votes.groupBy("qid").agg(F.map_from_entries(F.collect_list(F.struct("label", "prob"))).alias("probs"))
        return facts.join(pred, "qid").join(probs, "qid")
    return build() if fresh else materialize(spark, "knn_pred", sf, build)


@register("label_encode")
def q_label_encode(spark, sf):
    return FT.label_index(sl(spark, sf), C.TARGET).select("student_id", C.TARGET, "label")


@register("standard_scale")
def q_standard_scale(spark, sf):
    z = FT.standardize(sl(spark, sf), NUM)
    return z.select("student_id", *[F.round("z_" + c, 6).alias("z_" + c) for c in NUM])


@register("one_hot")
def q_one_hot(spark, sf):
    df = sl(spark, sf)
    cats = FT.interest_categories()
    return FT.one_hot(df, "interest", cats, prefix="oh_").select("student_id", *["oh_" + v for v in cats])


@register("stratified_split")
def q_split(spark, sf):
    return split_students(spark, sf).select("student_id", C.TARGET, "is_test")


@register("fold_assign")
def q_folds(spark, sf):
    return FT.stratified_folds(sl(spark, sf), C.TARGET).select("student_id", C.TARGET, "fold")


@register("knn_classify")
def q_knn_classify(spark, sf):
    p = knn_test_predictions(spark, sf, fresh=True)
    return p.select("student_id", "actual", "predicted", F.round("confidence", 6).alias("confidence"))


def knn_profile_votes(spark, sf) -> DataFrame:
    """The neighbour model's vote shares for every profile: student_id, probs."""
    def build():
        data = split_students(spark, sf)
        space = train_space(spark, sf)
        h = space.filter(~F.col("is_test")).select(F.col("row_order").alias("hid"), "vec")
        votes = vote(nearest(space.select(F.col("row_order").alias("qid"), "vec"), h, C.KNN_K), data.select(F.col("row_order").alias("hid"), F.col(C.TARGET).alias("label")))
        probs = votes.groupBy("qid").agg(F.map_from_entries(F.collect_list(F.struct("label", "prob"))).alias("probs"))   # a few classes
        return data.select(F.col("row_order").alias("qid"), "student_id").join(probs, "qid")
    return materialize(spark, "knn_votes", sf, build)


@register("predict_proba_dense")
def q_proba(spark, sf):
    """Every profile's probability for every track, ranked."""
    p = knn_profile_votes(spark, sf)
    classes = F.array(*[F.lit(t) for t in sorted(C.TRACK_NAMES)])
    long = p.select("student_id", F.explode(classes).alias("track"), "probs")
    pct = round_half_even(F.coalesce(F.col("probs")[F.col("track")], F.lit(0.0)) * 100.0, 1)
    long = long.select("student_id", "track", pct.alias("prob_pct"))
    w = Window.partitionBy("student_id").orderBy(F.col("prob_pct").desc(), F.col("track"))
    return long.withColumn("rank", F.row_number().over(w))


@register("accuracy")
def q_accuracy(spark, sf):
    return EV.accuracy(knn_test_predictions(spark, sf))


@register("classification_report")
def q_class_report(spark, sf):
    return EV.classification_report(knn_test_predictions(spark, sf), C.TRACK_NAMES)


@register("confusion_matrix")
def q_confusion(spark, sf):
    return EV.confusion_matrix(knn_test_predictions(spark, sf), sorted(C.TRACK_NAMES))


@register("model_summary")
def q_model_summary(spark, sf):
    p = knn_test_predictions(spark, sf)
    rep = EV.classification_report(p, C.TRACK_NAMES).filter(F.col("label") == "macro avg")
    acc = EV.accuracy(p).scalar()
    return rep.select(F.lit("knn").alias("model"), F.lit(C.ALGORITHM_LABELS["knn"]).alias("algorithm"),
                      acc.alias("accuracy_pct"), F.col("f1").alias("macro_f1"),
                      F.col("precision").alias("macro_precision"))


@register("knn_similar")
def q_knn_similar(spark, sf):
    data = split_students(spark, sf)
    v = train_space(spark, sf).select(F.col("row_order").alias("id"), "vec")
    nn = nearest(v.withColumnRenamed("id", "qid"), v.withColumnRenamed("id", "hid"), C.SIMILAR_STUDENTS)
    d4 = F.max("dist").over(Window.partitionBy("qid"))
    sim = round_half_even(F.greatest(F.lit(0.0), 100.0 - F.col("dist") / F.greatest(d4, F.lit(0.001)) * 25.0), 1)
    nn = nn.withColumn("similarity", sim)
    hist = data.select(F.col("row_order").alias("hid"), F.col("student_id").alias("neighbour_id"),
                       round_half_even("gpa", 2).alias("gpa"), safe_text("interest", "Undecided").alias("interest"),
                       safe_text(C.TARGET, "Unknown").alias("track"), safe_text("failed_courses").alias("failed_courses"))
    qs = data.select(F.col("row_order").alias("qid"), "student_id")
    return (nn.join(qs, "qid").join(hist, "hid")
            .select("student_id", "rank", "neighbour_id", "gpa", "interest", "track", "failed_courses",
                    F.round("dist", 6).alias("distance"), "similarity"))


def _embeddings(spark, sf) -> DataFrame:
    emb = read_table(spark, sf, "embeddings", ["vec_id", "embedding"])
    return emb.select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"))


@register("knn_visits")
def q_knn_visits(spark, sf):
    """What the metric index reads for the five nearest embeddings of each
    embedding: rows measured against all pairs of queries and rows."""
    v = _embeddings(spark, sf)
    search = Search(v.withColumnRenamed("id", "qid"), v.withColumnRenamed("id", "hid"), 5)
    seen = search.visits().agg(F.count("*").alias("n_queries"), F.sum("cells").alias("cells_visited"), F.sum("measured").alias("rows_measured"))
    return seen.select("n_queries", F.lit(search.rows).cast("long").alias("n_rows"), F.lit(len(search.index.pivots)).cast("long").alias("n_cells"),
                       "cells_visited", "rows_measured", (F.col("rows_measured") / F.col("n_queries") / F.lit(max(1, search.rows))).alias("share_measured"))


@register("approx_euclidean")
def q_approx(spark, sf):
    """Recall of the approximate search for five nearest embeddings."""
    v = _embeddings(spark, sf)
    q, h = v.withColumnRenamed("id", "qid"), v.withColumnRenamed("id", "hid")
    return recall(approx_nearest(q, h, 5), nearest(q, h, 5)).select("neighbours", "found", F.round("recall", 6).alias("recall"))


@register("pairwise_euclidean")
def q_pairwise(spark, sf):
    """Five nearest embeddings of every embedding (exact, whole table)."""
    v = _embeddings(spark, sf)
    nn = nearest(v.withColumnRenamed("id", "qid"), v.withColumnRenamed("id", "hid"), 5)
    return nn.select(F.col("qid").alias("vec_id"), F.col("hid").alias("neighbour_id"), "rank",
                     F.round("dist", 6).alias("distance"))


@register("knn_classify_embeddings")
def q_knn_embeddings(spark, sf):
    """Leave-one-out 9-NN label vote over the embeddings table."""
    emb = read_table(spark, sf, "embeddings", ["vec_id", "embedding", "label"])
    v = emb.select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"))
    nn = Search(v.withColumnRenamed("id", "qid"), v.withColumnRenamed("id", "hid"), C.KNN_K + 1).neighbours()   # through the index at any size
    nn = nn.filter(F.col("qid") != F.col("hid"))
    nn = nn.withColumn("rank", F.row_number().over(Window.partitionBy("qid").orderBy("dist", "hid"))) \
           .filter(F.col("rank") <= C.KNN_K)
    votes = vote(nn, emb.select(F.col("vec_id").alias("hid"), "label"))
    pred = predict_from_votes(votes)
    return pred.join(emb.select(F.col("vec_id").alias("qid"), F.col("label").alias("actual")), "qid") \
               .select(F.col("qid").alias("vec_id"), "actual", "predicted", F.round("confidence", 6).alias("confidence"))


@register("grouped_importance")
def q_grouped_importance(spark, sf):
    """Importance grouping (M15) over stand-in weights: each feature's share
    of total variance (SQL-checkable); forest weights use the same grouping
    in ``train_random_forest``."""
    df = sl(spark, sf)
    agg = df.agg(*[F.var_pop(F.col(c).cast("double")).alias(c) for c in NUM])
    long = agg.unpivot([], NUM, "feature", "weight")
    return EV.group_importance(long)


@register("train_decision_tree")
def q_train_tree(spark, sf):
    return EV.tree_predictions(split_students(spark, sf), "decision_tree")


@register("train_random_forest")
def q_train_forest(spark, sf):
    return EV.tree_predictions(split_students(spark, sf), "random_forest")


@register("forest_importance")
def q_forest_importance(spark, sf):
    return EV.forest_importance(split_students(spark, sf))


def folds_of(spark, sf) -> DataFrame:
    return materialize(spark, "folds", sf, lambda: FT.stratified_folds(sl(spark, sf), C.TARGET))


@register("cross_validate")
def q_cross_validate(spark, sf):
    """5-fold (unshuffled, stratified) KNN accuracy: per fold + mean/std."""
    return M.cross_validate_knn(folds_of(spark, sf))


def tree_folds(spark, sf) -> DataFrame:
    return materialize(spark, "tree_folds", sf, lambda: M.cross_validate_trees(folds_of(spark, sf)))


@register("cross_validate_trees")
def q_cross_validate_trees(spark, sf):
    """The same folds for the two trees: per fold, mean and std of the accuracy."""
    return tree_folds(spark, sf)


def bundle(spark, sf) -> dict:
    """The saved models of the labelled students, fitted once per session."""
    path = store_path(spark, "models", sf)
    try:
        return M.load_models(spark, path)
    except M.MissingBundleError:
        M.save_models(split_students(spark, sf), saved_target_rules(spark, sf), path)
        return M.load_models(spark, path)


@register("compare_models")
def q_compare_models(spark, sf):
    """Every student through the three trained models: track, confidence,
    agreement with the chosen algorithm's track, and test accuracy."""
    profiles = sl(spark, sf).withColumn("algorithm", F.lit(C.DEFAULT_ALGORITHM))
    return M.compare(bundle(spark, sf), profiles)


@register("evaluate_models")
def q_evaluate_models(spark, sf):
    """Test confusion cells of the three models."""
    return bundle(spark, sf)["confusion"].select("model", "actual", "predicted", "count")


@register("model_cards_knn")
def q_model_cards_knn(spark, sf):
    """The neighbour model's card: accuracy, report, confusion, cross-validation."""
    pred = knn_test_predictions(spark, sf).select(F.lit("knn").alias("model"), "actual", "predicted")
    return M.model_cards(pred, M.cross_validate_knn(folds_of(spark, sf)).withColumn("model", F.lit("knn")))


@register("model_cards")
def q_model_cards(spark, sf):
    """The cards of the three saved models, the forest's with its importances."""
    models = bundle(spark, sf)
    cv = M.cross_validate_knn(folds_of(spark, sf)).withColumn("model", F.lit("knn")).select("model", "cv_mean", "cv_std")
    cv = cv.unionByName(tree_folds(spark, sf).select("model", "cv_mean", "cv_std"))
    return M.model_cards(models["test_predictions"], cv, models["importance"])
