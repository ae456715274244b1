"""Model bundle: round trip, invariants of the predictions, missing bundle."""

import pytest
from pyspark.sql import functions as F

from quarry import config as C
from quarry.operators import features as FT
from quarry.plans import models as M
from quarry.plans.derived import sl
from quarry.plans.q_ml import bundle, split_students
from quarry.plans.q_rules import saved_target_rules
from quarry.sources.csv_text import MissingInputError, read_text_csv


@pytest.fixture(scope="module")
def small(spark):
    """Small trees: the same code in seconds."""
    trees, C.RF_TREES = C.RF_TREES, 12
    yield
    C.RF_TREES = trees


def test_round_trip_and_predictions(spark, sf, small, tmp_path):
    M.save_models(split_students(spark, sf), saved_target_rules(spark, sf), str(tmp_path / "bundle"))
    first, again = (M.load_models(spark, str(tmp_path / "bundle")) for _ in range(2))
    students = sl(spark, sf).withColumn("algorithm", F.lit(C.DEFAULT_ALGORITHM))
    n = students.count()
    out = M.compare(first, students).cache()
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, M.compare(again, students).collect()))
    by = {r["model"]: r for r in out.groupBy("model").agg(F.count("*").alias("n"), F.count_distinct("student_id").alias("ids"), F.min("confidence").alias("lo"), F.max("confidence").alias("hi"),
                                                          F.max("accuracy").alias("acc"), F.count_if("agrees").alias("agrees")).collect()}
    assert set(by) == set(M.MODELS) and all(r["n"] == r["ids"] == n for r in by.values())
    assert all(0 < r["lo"] <= r["hi"] <= 100 and r["acc"] > 30 for r in by.values())
    assert by[C.DEFAULT_ALGORITHM]["agrees"] == n and by["knn"]["agrees"] < n
    right = out.join(students.select("student_id", C.TARGET), "student_id").filter("model = 'decision_tree'").agg(F.avg((F.col("track") == F.col(C.TARGET)).cast("double"))).first()[0]
    assert 0.5 < right < 1   # it isn't the label
    assert first["importance"].agg(F.round(F.sum("importance"), 4)).first()[0] == 1
    assert [r["rank"] for r in first["importance"].orderBy("rank").collect()] == list(range(1, first["importance"].count() + 1))
    test_rows = split_students(spark, sf).filter("is_test").count()
    assert {r["model"]: r["n"] for r in first["confusion"].groupBy("model").agg(F.sum("count").alias("n")).collect()} == dict.fromkeys(M.MODELS, test_rows)


def test_missing_bundle_and_input(spark, tmp_path):
    with pytest.raises(M.MissingBundleError):
        M.load_models(spark, str(tmp_path / "none"))
    with pytest.raises(MissingInputError):
        read_text_csv(spark, str(tmp_path / "none.csv"))


def test_columns_are_matched_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("y,x,z\nY1,X1,\n,\"\",nan\n")
    assert [tuple(r) for r in read_text_csv(spark, str(tmp_path / "a.csv"), ["x", "y"]).collect()] == [("X1", "Y1"), ("", "")]
    with pytest.raises(ValueError):
        read_text_csv(spark, str(tmp_path / "a.csv"), ["x", "w"])
    with pytest.raises(MissingInputError):
        read_text_csv(spark, str(tmp_path / "b.csv"), ["x"])


@pytest.fixture(scope="module")
def models(spark, sf, small, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("models") / "bundle")
    M.save_models(split_students(spark, sf), saved_target_rules(spark, sf), path)
    return M.load_models(spark, path)


def test_tree_folds_and_cards(spark, sf, small, models):
    """A row for each model and fold; the cards say what the bundle's tables hold."""
    from quarry.plans.q_ml import folds_of
    from quarry.session import hand_off
    folds = hand_off(M.cross_validate_trees(folds_of(spark, sf)), "test-folds")
    rows = folds.collect()
    assert sorted((r["model"], r["fold"]) for r in rows) == sorted((m, f) for m in M.TREES for f in range(C.CV_FOLDS))
    for m in M.TREES:
        mine = [r for r in rows if r["model"] == m]
        assert all(30 < r["accuracy_pct"] <= 100 for r in mine) and len({(r["cv_mean"], r["cv_std"]) for r in mine}) == 1
        mean = sum(r["accuracy_pct"] for r in mine) / len(mine)
        assert abs(mine[0]["cv_mean"] - mean) < 0.02
        assert abs(mine[0]["cv_std"] - (sum((r["accuracy_pct"] - mean) ** 2 for r in mine) / len(mine)) ** 0.5) < 0.02
    cards = {(r["model"], r["figure"], r["item"]): r["value"] for r in M.model_cards(models["test_predictions"], folds, models["importance"]).collect()}
    test = models["test_predictions"].collect()
    for m in M.MODELS:
        mine = [r for r in test if r["model"] == m]
        assert abs(cards[m, "accuracy", ""] - 100 * sum(r["actual"] == r["predicted"] for r in mine) / len(mine)) < 0.01
        for a in C.TRACK_NAMES:
            assert cards[m, "support", a] == sum(r["actual"] == a for r in mine)
            given, hit = sum(r["predicted"] == a for r in mine), sum(r["predicted"] == a == r["actual"] for r in mine)
            assert abs(cards[m, "precision", a] - (hit / given if given else 0)) < 1e-5
            assert all(cards[m, "confusion", f"{a} > {b}"] == sum(r["actual"] == a and r["predicted"] == b for r in mine) for b in C.TRACK_NAMES)
    assert abs(sum(v for (_, f, _), v in cards.items() if f == "importance") - 1) < 1e-3
    assert {m for m, f, _ in cards if f == "cv_mean"} == set(M.TREES)


def test_reports_of_dirty_requests_by_the_models(spark, sf, small, models):
    from quarry.plans import advise as A
    from quarry.plans.derived import sr
    from quarry.plans.q_advise import raw_requests
    asked = raw_requests(spark, sf)
    got = {r["row_order"]: r for r in A.model_advice(models, asked).collect()}
    assert len(got) == asked.count() == sr(spark, sf).select("row_order").distinct().count()
    wanted = {r["row_order"]: r["algorithm"] for r in asked.select("row_order", "algorithm").collect()}
    assert {None, "svm", *C.ALGORITHM_LABELS} == set(wanted.values())
    answers = {(int(r["student_id"]), r["model"]): r for r in M.predict_all(models, A.model_profiles(asked)).collect()}
    accuracy = {r["model"]: r["accuracy_pct"] for r in models["metrics"].collect()}
    for i, r in got.items():
        model = wanted[i] if wanted[i] in C.ALGORITHM_LABELS else C.DEFAULT_ALGORITHM
        assert r["algorithm"] == model and r["track"] == answers[i, model]["predicted"] and r["accuracy"] == accuracy[model]
        assert abs(r["confidence"] - 100 * answers[i, model]["confidence"]) <= 0.0501
        assert [x["algorithm"] for x in r["comparison"]] == list(C.ALGORITHM_LABELS.values())
        assert [x["agrees"] for x in r["comparison"]] == [answers[i, m]["predicted"] == r["track"] for m in C.ALGORITHM_LABELS]
        assert any(f"{r['track']} the highest confidence score at {r['confidence']}%" in x for x in r["explanation"])
        assert [x["term_no"] for x in r["plan"]] == [1, 2, 3] and r["careers"] == C.TRACK_BY_NAME[r["track"]]["careers"] and r["warnings"]
        assert [x["rank"] for x in r["similar"]] == [1, 2, 3, 4] and r["similar"][0]["similarity"] >= r["similar"][3]["similarity"] >= 75
        assert 0 <= r["gpa"] <= 4 or r["gpa"] != r["gpa"]


def _plan(df, capsys):
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


def test_statistics_are_one_subquery(spark, sf, capsys):
    """Each mention of a scalar subquery is a copy of its plan on the driver."""
    from quarry.plans.q_ml import split_students
    data = split_students(spark, sf)
    few, all_ = (len(_plan(FT.standardize(data, cols, fit=data.filter("not is_test")), capsys)) for cols in (M.NUM[:5], M.NUM))
    assert all_ < 2 * few * len(M.NUM) / 5 and all_ < 100_000   # in proportion to the columns, not to their square


def test_every_model_is_asked_once(spark, sf, small, models, capsys):
    students = sl(spark, sf).withColumn("algorithm", F.lit(C.DEFAULT_ALGORITHM))
    plan = _plan(M.compare(models, students), capsys)
    assert not any(x in plan for x in ("CoGroup", "MapInArrow", "Window"))


def test_fold_statistics_leave_rows_where_they_are(spark, sf, monkeypatch, capsys):
    from quarry.plans.q_ml import folds_of
    seen = []

    class Stop(Exception):
        pass

    def stop(queries, history, *a, **b):
        seen.append(history)
        raise Stop

    monkeypatch.setattr(M, "nearest", stop)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with pytest.raises(Stop):
            M.cross_validate_knn(folds_of(spark, sf))
        plan = _plan(seen[0], capsys)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_kinds_of_trees_are_fitted_side_by_side(spark, sf, monkeypatch):
    import threading

    from quarry.plans.q_ml import folds_of
    both = threading.Barrier(2, timeout=30)

    class Met(Exception):
        pass

    def met(rows, kind):
        both.wait()
        raise Met

    monkeypatch.setattr(M.EV, "fit_rows", met)
    with pytest.raises(Met):
        M.cross_validate_trees(folds_of(spark, sf))


def test_form_inputs_are_parsed_once(spark, capsys):
    from quarry.functions.numeric import clamp_float_input, clamp_int_input, coerce_numeric
    values = {None: (70, 0.0), "": (70, 0.0), "nan": (70, 4.0), "inf": (100, 4.0), "-inf": (0, 0.0), "3.7": (3, 3.7), "-0.5": (0, 0.0), "150": (100, 4.0), "1e400": (100, 4.0), "x": (70, 0.0)}
    rows = spark.createDataFrame([(v,) for v in values], "v string").repartition(1)
    out = rows.select("v", clamp_int_input("v").alias("i"), clamp_float_input("v").alias("f"))
    assert {r["v"]: (r["i"], r["f"]) for r in out.collect()} == values
    count = lambda c: _plan(rows.select(c.alias("x")), capsys).count("RLIKE")
    once = count(coerce_numeric("v"))
    assert once and count(clamp_int_input("v")) == once and count(clamp_float_input("v")) <= once + 1


def test_report_texts_are_planned_apart_from_joins(spark, sf, small, models, capsys):
    from quarry.plans import advise as A
    from quarry.plans.q_advise import raw_requests
    assert "Join" not in _plan(A.model_advice(models, raw_requests(spark, sf)), capsys)
