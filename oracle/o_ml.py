"""Oracle SQL for encodings, split, kNN models and evaluation."""

from __future__ import annotations

import re

from oracle.catalog import oracle
from oracle.sql import q, rnd, with_ctes
from quarry import config as C

NUM = C.NUMERIC_FEATURES
T = C.TARGET
CATS = sorted(C.VALID_INTERESTS)
SL = with_ctes("sl")


def split_cte() -> str:
    return f"""
split AS (
  SELECT *, (row_number() OVER (PARTITION BY {T} ORDER BY (row_order * 7919 + 42) % 1000003, row_order) - 1)
            < floor((count(*) OVER (PARTITION BY {T}) * 2 + 5) / 10) AS is_test
  FROM sl
)"""


def space_cte(src: str, fit_pred: str, name: str = "space") -> str:
    """z-scores with population std of the fit rows; one-hot of interest."""
    stats = ", ".join(f"avg(CAST({c} AS DOUBLE)) AS m_{c}, stddev_pop(CAST({c} AS DOUBLE)) AS s_{c}" for c in NUM)
    zs = ", ".join(f"(CAST(t.{c} AS DOUBLE) - st.m_{c}) / (CASE WHEN st.s_{c} IS NULL OR st.s_{c} < 1e-12 "
                   f"THEN 1.0 ELSE st.s_{c} END) AS z_{c}" for c in NUM)
    oh = ", ".join(f"CAST(t.interest = {q(v)} AS DOUBLE) AS oh_{i}" for i, v in enumerate(CATS))
    return f"""
{name}_st AS (SELECT {stats} FROM {src} WHERE {fit_pred}),
{name} AS (SELECT t.*, {zs}, {oh} FROM {src} t, {name}_st st)"""


def dist(a: str, b: str) -> str:
    terms = [f"(CAST({a}.z_{c} AS DOUBLE) - {b}.z_{c}) * ({a}.z_{c} - {b}.z_{c})" for c in NUM]
    terms += [f"({a}.oh_{i} - {b}.oh_{i}) * ({a}.oh_{i} - {b}.oh_{i})" for i in range(len(CATS))]
    return "sqrt(" + " + ".join(terms) + ")"


SPLIT = with_ctes("sl", split_cte())
KNN_ALL = with_ctes("sl", split_cte() + "," + space_cte("split", "NOT is_test") + f""",
nn AS (
  SELECT q.row_order AS qid, h.row_order AS hid, h.{T} AS label, {dist('q', 'h')} AS dist
  FROM space q JOIN space h ON NOT h.is_test
  QUALIFY row_number() OVER (PARTITION BY q.row_order ORDER BY dist, h.row_order) <= {C.KNN_K}
), wts AS (
  SELECT *, CASE WHEN max(CAST(dist = 0 AS INTEGER)) OVER (PARTITION BY qid) = 1
                 THEN CAST(dist = 0 AS DOUBLE) ELSE 1.0 / dist END AS w FROM nn
), votes AS (
  SELECT qid, label, sum(w) AS score FROM wts GROUP BY qid, label
), probs AS (
  SELECT qid, label, score, score / sum(score) OVER (PARTITION BY qid) AS prob FROM votes
), pred AS (
  SELECT p.qid, s.student_id, s.{T} AS actual, p.label AS predicted, p.prob AS confidence
  FROM probs p JOIN split s ON p.qid = s.row_order
  QUALIFY row_number() OVER (PARTITION BY p.qid ORDER BY p.score DESC, p.label) = 1
)""")
KNN = KNN_ALL.replace("ON NOT h.is_test", "ON q.is_test AND NOT h.is_test")

oracle("label_encode", SL + f"SELECT student_id, {T}, CAST(dense_rank() OVER (ORDER BY {T}) - 1 AS INTEGER) AS label FROM sl")
oracle("standard_scale", with_ctes("sl", space_cte("sl", "true")) + "SELECT student_id, "
       + ", ".join(f"round(z_{c}, 6) AS z_{c}" for c in NUM) + " FROM space")
oracle("one_hot", SL + "SELECT student_id, " + ", ".join(
    f"CAST(interest = {q(v)} AS DOUBLE) AS \"oh_{v}\"" for v in CATS) + " FROM sl")
oracle("stratified_split", SPLIT + f"SELECT student_id, {T}, is_test FROM split")
FOLDS = with_ctes("sl", f"""
cls AS (
  SELECT {T}, count(*) AS n_c, min(row_order) AS first FROM sl GROUP BY {T}
), cls2 AS (
  SELECT {T}, n_c, coalesce(sum(n_c) OVER (ORDER BY first ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM cls
), bnd AS (
  SELECT {T}, {", ".join(
      "(" + " + ".join(f"(floor((start + n_c - 1 - {g}) / {C.CV_FOLDS}) - floor((start - 1 - {g}) / {C.CV_FOLDS}))"
                       for g in range(f + 1)) + f") AS b{f}" for f in range(C.CV_FOLDS))}
  FROM cls2
), ranked AS (
  SELECT s.student_id, s.{T}, s.row_order, row_number() OVER (PARTITION BY s.{T} ORDER BY s.row_order) - 1 AS j
  FROM sl s
)""")
FOLD_CASE = "CASE " + " ".join(f"WHEN j < b{f} THEN {f}" for f in range(C.CV_FOLDS - 1)) + f" ELSE {C.CV_FOLDS - 1} END"
oracle("fold_assign", FOLDS + f"SELECT r.student_id, r.{T}, CAST({FOLD_CASE} AS INTEGER) AS fold "
       f"FROM ranked r JOIN bnd b ON r.{T} = b.{T}")
oracle("knn_classify", KNN + "SELECT student_id, actual, predicted, round(confidence, 6) AS confidence FROM pred")
oracle("predict_proba_dense", KNN_ALL + f""", dense AS (
  SELECT p.qid, s.student_id, c.track, {rnd('coalesce(pr.prob, 0.0) * 100.0', 1)} AS prob_pct
  FROM pred p JOIN split s ON p.qid = s.row_order
  CROSS JOIN (SELECT unnest([{", ".join(q(t) for t in sorted(C.TRACK_NAMES))}]) AS track) c
  LEFT JOIN probs pr ON pr.qid = p.qid AND pr.label = c.track
)
SELECT student_id, track, prob_pct, row_number() OVER (PARTITION BY student_id ORDER BY prob_pct DESC, track) AS rank
FROM dense""")
oracle("accuracy", KNN + f"SELECT {rnd('avg(CAST(actual = predicted AS DOUBLE)) * 100.0', 2)} AS accuracy_pct FROM pred")
LABELS = "(SELECT unnest([" + ", ".join(q(t) for t in sorted(C.TRACK_NAMES)) + "]) AS label)"
REPORT = f""", per AS (
  SELECT l.label,
    coalesce((SELECT count(*) FROM pred WHERE actual = l.label AND predicted = l.label), 0) AS tp,
    coalesce((SELECT count(*) FROM pred WHERE actual = l.label), 0) AS support,
    coalesce((SELECT count(*) FROM pred WHERE predicted = l.label), 0) AS pp
  FROM {LABELS} l
), per2 AS (
  SELECT label, tp, support,
    CASE WHEN pp > 0 THEN tp / pp ELSE 0.0 END AS precision,
    CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall
  FROM per
), per3 AS (
  SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM per2
), allrows AS (
  SELECT label, precision, recall, f1, support FROM per3
  UNION ALL SELECT 'accuracy', sum(tp) / sum(support), sum(tp) / sum(support), sum(tp) / sum(support), sum(support) FROM per3
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM per3
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                   sum(f1 * support) / sum(support), sum(support) FROM per3
)
"""
oracle("classification_report", KNN + REPORT + "SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, "
       "round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM allrows")
oracle("confusion_matrix", KNN + f"SELECT a.label AS actual, p.label AS predicted, CAST((SELECT count(*) FROM pred x "
       f"WHERE x.actual = a.label AND x.predicted = p.label) AS BIGINT) AS count FROM {LABELS} a, {LABELS} p")
oracle("model_summary", KNN + REPORT + "SELECT 'knn' AS model, 'K-Nearest Neighbors' AS algorithm, "
       f"(SELECT {rnd('avg(CAST(actual = predicted AS DOUBLE)) * 100.0', 2)} FROM pred) AS accuracy_pct, "
       "round(f1, 6) AS macro_f1, round(precision, 6) AS macro_precision FROM allrows WHERE label = 'macro avg'")


def safe(x: str, default: str) -> str:
    return (rf"CASE WHEN {x} IS NULL OR lower(regexp_replace({x}, '^\s+|\s+$', '', 'g')) IN ('', 'none', 'nan', 'null') "
            rf"THEN {q(default)} ELSE regexp_replace({x}, '^\s+|\s+$', '', 'g') END")


SIM = with_ctes("sl", split_cte() + "," + space_cte("split", "NOT is_test") + f""",
nn AS (
  SELECT q.student_id, q.row_order AS qid, h.row_order AS hid, {dist('q', 'h')} AS dist,
    row_number() OVER (PARTITION BY q.row_order ORDER BY {dist('q', 'h')}, h.row_order) AS rank
  FROM space q, space h
  QUALIFY rank <= {C.SIMILAR_STUDENTS}
)""")
oracle("knn_similar", SIM + f"""SELECT n.student_id, n.rank, h.student_id AS neighbour_id, {rnd('h.gpa', 2)} AS gpa,
  {safe('h.interest', 'Undecided')} AS interest, {safe('h.' + T, 'Unknown')} AS track,
  {safe('h.failed_courses', 'None')} AS failed_courses, round(n.dist, 6) AS distance,
  {rnd('GREATEST(0.0, 100.0 - n.dist / GREATEST(max(n.dist) OVER (PARTITION BY n.qid), 0.001) * 25.0)', 1)} AS similarity
FROM nn n JOIN split h ON n.hid = h.row_order""")
EMB = """WITH ev AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings),
pairs AS (
  SELECT a.vec_id AS qid, b.vec_id AS hid, b.label AS label,
    sqrt(list_sum(list_transform(list_zip(a.v, b.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS dist
  FROM ev a, ev b
)"""
oracle("pairwise_euclidean", EMB + """
SELECT qid AS vec_id, hid AS neighbour_id, row_number() OVER (PARTITION BY qid ORDER BY dist, hid) AS rank,
  round(dist, 6) AS distance FROM pairs QUALIFY rank <= 5""")
oracle("knn_classify_embeddings", EMB + f""", nn AS (
  SELECT * FROM pairs WHERE qid <> hid QUALIFY row_number() OVER (PARTITION BY qid ORDER BY dist, hid) <= {C.KNN_K}
), wts AS (
  SELECT *, CASE WHEN max(CAST(dist = 0 AS INTEGER)) OVER (PARTITION BY qid) = 1
                 THEN CAST(dist = 0 AS DOUBLE) ELSE 1.0 / dist END AS w FROM nn
), votes AS (SELECT qid, label, sum(w) AS score FROM wts GROUP BY qid, label),
probs AS (SELECT qid, label, score, score / sum(score) OVER (PARTITION BY qid) AS prob FROM votes)
SELECT p.qid AS vec_id, e.label AS actual, p.label AS predicted, round(p.prob, 6) AS confidence
FROM probs p JOIN embeddings e ON e.vec_id = p.qid
QUALIFY row_number() OVER (PARTITION BY p.qid ORDER BY p.score DESC, p.label) = 1""")


def group_sql(f: str) -> str:
    g = C.IMPORTANCE_GROUPS
    title = (f"array_to_string(list_transform(string_split(replace(regexp_replace({f}, '_grade$', ''), '_', ' '), ' '), "
             f"lambda w: upper(left(w, 1)) || lower(substr(w, 2))), ' ')")
    return (f"CASE WHEN starts_with({f}, 'interest_') OR starts_with({f}, 'oh_') THEN {q(g['interest'])} "
            f"WHEN ends_with({f}, '_failed') OR ends_with({f}, '_passed') OR {f} IN ('passed_count', 'failed_count') "
            f"THEN {q(g['flags'])} WHEN {f} = 'gpa' THEN {q(g['gpa'])} "
            f"WHEN {f} = 'excellent_count' THEN {q(g['excellent_count'])} "
            f"WHEN {f} = 'weak_count' THEN {q(g['weak_count'])} ELSE {title} || ' Grade' END")


VARS = " UNION ALL ".join(f"SELECT {q(c)} AS feature, var_pop(CAST({c} AS DOUBLE)) AS weight FROM sl" for c in NUM)
oracle("grouped_importance", SL + f"SELECT {group_sql('feature')} AS \"group\", "
       f"round(sum(weight) / (SELECT sum(weight) FROM ({VARS}) z), 6) AS importance FROM ({VARS}) t GROUP BY 1")

FOLD_STATS = " UNION ALL ".join(
    f"SELECT {f} AS part, " + ", ".join(f"avg(CAST({c} AS DOUBLE)) AS m_{c}, stddev_pop(CAST({c} AS DOUBLE)) AS s_{c}" for c in NUM)
    + f" FROM folded WHERE fold <> {f}" for f in range(C.CV_FOLDS))
FOLD_Z = ", ".join(f"(CAST(t.{c} AS DOUBLE) - st.m_{c}) / (CASE WHEN st.s_{c} IS NULL OR st.s_{c} < 1e-12 THEN 1.0 ELSE st.s_{c} END) AS z_{c}" for c in NUM)
FOLD_OH = ", ".join(f"CAST(t.interest = {q(v)} AS DOUBLE) AS oh_{i}" for i, v in enumerate(CATS))
CV = f"""folded AS (
  SELECT s.*, CAST({FOLD_CASE} AS INTEGER) AS fold FROM sl s JOIN ranked r ON s.row_order = r.row_order JOIN bnd b ON r.{T} = b.{T}
), fold_st AS ({FOLD_STATS}
), space AS (
  SELECT st.part, t.fold, t.row_order, t.{T}, {FOLD_Z}, {FOLD_OH} FROM folded t, fold_st st
), nn AS (
  SELECT q.part, q.row_order AS qid, q.{T} AS actual, h.{T} AS label, {dist('q', 'h')} AS dist
  FROM space q JOIN space h ON q.part = h.part AND q.fold = q.part AND h.fold <> h.part
  QUALIFY row_number() OVER (PARTITION BY q.row_order ORDER BY dist, h.row_order) <= {C.KNN_K}
), wts AS (
  SELECT *, CASE WHEN max(CAST(dist = 0 AS INTEGER)) OVER (PARTITION BY qid) = 1 THEN CAST(dist = 0 AS DOUBLE) ELSE 1.0 / dist END AS w FROM nn
), votes AS (SELECT part, qid, actual, label, sum(w) AS score FROM wts GROUP BY ALL
), pred AS (
  SELECT * FROM votes QUALIFY row_number() OVER (PARTITION BY qid ORDER BY score DESC, label) = 1
), per AS (SELECT part AS fold, avg(CAST(actual = label AS DOUBLE)) AS acc FROM pred GROUP BY part)
"""
oracle("cross_validate", FOLDS + ", " + CV + f"""SELECT fold, round(acc * 100.0, 2) AS accuracy_pct, (SELECT {rnd('avg(acc) * 100.0', 2)} FROM per) AS cv_mean,
  (SELECT {rnd('stddev_pop(acc) * 100.0', 2)} FROM per) AS cv_std FROM per""")

CARD_CV = CV
for name in ("space", "nn", "wts", "votes", "pred", "per", "fold_st", "folded"):
    CARD_CV = re.sub(rf"\b{name}\b", f"cv_{name}", CARD_CV)
FOLDS_TAIL = FOLDS[FOLDS.index("cls AS ("):]
oracle("model_cards_knn", KNN + ", " + FOLDS_TAIL + ", " + CARD_CV.rstrip() + f""", cells AS (
  SELECT a.label AS actual, p.label AS predicted, CAST((SELECT count(*) FROM pred x WHERE x.actual = a.label AND x.predicted = p.label) AS DOUBLE) AS n
  FROM {LABELS} a, {LABELS} p
), sides AS (
  SELECT l.label AS item, (SELECT sum(n) FROM cells WHERE actual = l.label) AS support, (SELECT sum(n) FROM cells WHERE predicted = l.label) AS given,
    (SELECT sum(n) FROM cells WHERE actual = l.label AND predicted = l.label) AS hit FROM {LABELS} l
), rates AS (
  SELECT item, support, CASE WHEN given > 0 THEN hit / given ELSE 0.0 END AS precision, CASE WHEN support > 0 THEN hit / support ELSE 0.0 END AS recall FROM sides
)
SELECT 'knn' AS model, 'accuracy' AS figure, '' AS item, (SELECT {rnd('sum(CASE WHEN actual = predicted THEN n ELSE 0 END) / sum(n) * 100.0', 2)} FROM cells) AS value
UNION ALL SELECT 'knn', 'precision', item, round(precision, 6) FROM rates UNION ALL SELECT 'knn', 'recall', item, round(recall, 6) FROM rates
UNION ALL SELECT 'knn', 'f1', item, round(CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END, 6) FROM rates
UNION ALL SELECT 'knn', 'support', item, support FROM rates
UNION ALL SELECT 'knn', 'confusion', actual || ' > ' || predicted, n FROM cells
UNION ALL SELECT 'knn', 'cv_mean', '', (SELECT {rnd('avg(acc) * 100.0', 2)} FROM cv_per)
UNION ALL SELECT 'knn', 'cv_std', '', (SELECT {rnd('stddev_pop(acc) * 100.0', 2)} FROM cv_per)""")
