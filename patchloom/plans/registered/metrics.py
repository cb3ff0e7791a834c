"""Metrics, comparison, gate."""

from pyspark.sql import functions as F

from patchloom.functions.vectors import argmax
from patchloom.operators.gate import Threshold, gate_report, report_text
from patchloom.operators.metrics import (
    baseline_comparison,
    confusion,
    custom_metrics,
    latest_version,
    loss_and_accuracy,
    metrics_long,
    weighted_metrics,
)
from patchloom.plans.registered import query, table

# A mostly right candidate and a weaker baseline, both fixed by the row.
SCORED_SQL = """
    SELECT vec_id, label,
           CASE WHEN vec_id % 5 = 0 THEN list_position(embedding[1:32], list_max(embedding[1:32])) - 1 ELSE label END AS c,
           CASE WHEN vec_id % 2 = 0 THEN list_position(embedding[33:], list_max(embedding[33:])) - 1 ELSE label END AS b
    FROM embeddings
"""


def scored(spark, folder):
    rows = table(spark, folder, "embeddings")
    return rows.select(
        "vec_id",
        "label",
        F.when(F.col("vec_id") % 5 == 0, argmax(F.slice("embedding", 1, 32))).otherwise(F.col("label")).alias("prediction"),
        F.when(F.col("vec_id") % 2 == 0, argmax(F.slice("embedding", F.lit(33), F.size("embedding"))))
        .otherwise(F.col("label"))
        .alias("baseline_prediction"),
    )


METRICS_SQL = f"""
    s AS ({SCORED_SQL}),
    r AS (SELECT 'candidate' AS role, label, c AS p FROM s UNION ALL SELECT 'baseline', label, b FROM s),
    k AS (SELECT role, label AS cls, count(*) AS support, sum(CASE WHEN p = label THEN 1 ELSE 0 END) AS hits
          FROM r GROUP BY role, label),
    q AS (SELECT role, p AS cls, count(*) AS called FROM r GROUP BY role, p),
    pc AS (SELECT role, support, hits, CASE WHEN coalesce(called, 0) > 0 THEN hits / called::DOUBLE ELSE 0 END AS pr,
                  hits / support::DOUBLE AS re FROM k LEFT JOIN q USING (role, cls)),
    m AS (SELECT role, sum(support * CASE WHEN pr + re > 0 THEN 2 * pr * re / (pr + re) ELSE 0 END) / sum(support) AS f1_score,
                 sum(support * pr) / sum(support) AS precision, sum(support * re) / sum(support) AS recall,
                 sum(hits) / sum(support)::DOUBLE AS accuracy, sum(support)::BIGINT AS n_rows FROM pc GROUP BY role),
    long AS (SELECT role, unnest(['f1_score', 'precision', 'recall', 'accuracy']) AS metric_name,
                    unnest([f1_score, precision, recall, accuracy]) AS value FROM m),
    wide AS (SELECT metric_name, max(CASE WHEN role = 'candidate' THEN value END) AS candidate,
                    max(CASE WHEN role = 'baseline' THEN value END) AS baseline FROM long GROUP BY metric_name)
"""


def _rounded(df, *columns):
    return df.withColumns({c: F.round(c, 9) for c in columns})


@query(
    f"""
    WITH s AS ({SCORED_SQL})
    SELECT role, label::DOUBLE AS label, p::DOUBLE AS predicted, count(*) AS n FROM (
        SELECT 'candidate' AS role, label, c AS p FROM s UNION ALL SELECT 'baseline', label, b FROM s) GROUP BY role, label, p
    """
)
def confusion_counts(spark, folder):
    return confusion(scored(spark, folder), "label", {"candidate": "prediction", "baseline": "baseline_prediction"})


@query(
    f"""
    WITH {METRICS_SQL} SELECT role, round(f1_score, 9) AS f1_score, round(precision, 9) AS precision,
         round(recall, 9) AS recall, round(accuracy, 9) AS accuracy, n_rows, 0 AS n_unlabelled, 0 AS n_unpredicted
    FROM m WHERE role = 'candidate'
    """
)
def weighted_class_metrics(spark, folder):
    return _rounded(weighted_metrics(scored(spark, folder)), "f1_score", "precision", "recall", "accuracy")


@query(
    f"""
    WITH {METRICS_SQL} SELECT metric_name, round(candidate, 9) AS candidate, round(baseline, 9) AS baseline,
         round(candidate - baseline, 9) AS absolute_change, round((candidate - baseline) / baseline, 9) AS relative_change
    FROM wide
    """
)
def baseline_compare(spark, folder):
    compared = baseline_comparison(scored(spark, folder))
    return _rounded(compared, "candidate", "baseline", "absolute_change", "relative_change")


RULES = (
    Threshold("accuracy", 0.8),
    Threshold("f1_score", 0.5),
    Threshold("recall", 0.999),
    Threshold("precision", 0.4, higher_is_better=False),
    Threshold("auc", 0.7),
)


@query(
    f"""
    WITH {METRICS_SQL},
    rules AS (SELECT * FROM (VALUES ('accuracy', 0.8::DOUBLE, true), ('f1_score', 0.5::DOUBLE, true),
        ('recall', 0.999::DOUBLE, true), ('precision', 0.4::DOUBLE, false), ('auc', 0.7::DOUBLE, true))
        v(metric_name, threshold, higher_is_better))
    SELECT metric_name, round(candidate, 9) AS candidate, round(baseline, 9) AS baseline, threshold, higher_is_better,
           coalesce(CASE WHEN higher_is_better THEN candidate >= threshold ELSE candidate <= threshold END, false) AS passed
    FROM wide FULL JOIN rules USING (metric_name)
    """
)
def gate_verdicts(spark, folder):
    compared = baseline_comparison(scored(spark, folder))
    return _rounded(gate_report(compared, RULES), "candidate", "baseline")


@query(
    f"""
    WITH {METRICS_SQL} SELECT 'metrics' AS part, 1 AS place,
           rpad(metric_name, 30, ' ') || '  ' || rpad(printf('%.6f', candidate), 30, ' ') || '  N/A' AS line FROM wide
    UNION ALL SELECT 'metrics', 0, rpad('metric_name', 30, ' ') || '  ' || rpad('candidate', 30, ' ') || '  baseline'
    UNION ALL SELECT 'thresholds', 1, rpad(name, 30, ' ') || '  ' || value
    FROM (VALUES ('accuracy', '0.8'), ('f1_score', '0.5'), ('recall', '0.999'), ('precision', '0.4'), ('auc', '0.7')) v(name, value)
    """
)
def gate_text(spark, folder):
    long = metrics_long(weighted_metrics(scored(spark, folder)))
    rows = long.select("metric_name", F.col("value").alias("candidate"))
    text = F.when(F.col("candidate").isNotNull(), F.format_string("%.6f", F.col("candidate")))
    return report_text(gate_report(rows, RULES).withColumn("candidate", text))


@query(
    """
    SELECT l_returnflag,
           round(sum((1 / p) * (p - y) * (p - y)) / sum(1 / p), 6) AS weighted_mean_squared_error,
           round(sum((p - y + 1) * (p - y + 1)), 2) AS squared_diff_plus_one
    FROM (SELECT l_returnflag, l_quantity AS y, 1 + (l_partkey % 50) + l_discount * 10 AS p FROM lineitem)
    GROUP BY l_returnflag
    """
)
def custom_regression_metrics(spark, folder):
    lines = table(spark, folder, "lineitem", "l_returnflag", "l_quantity", "l_partkey", "l_discount")
    rows = lines.select(
        "l_returnflag",
        F.col("l_quantity").alias("target"),
        (1 + F.col("l_partkey") % 50 + F.col("l_discount") * 10).alias("prediction"),
    )
    found = custom_metrics(rows, "target", "prediction", by=["l_returnflag"])
    return found.select(
        "l_returnflag",
        F.round("weighted_mean_squared_error", 6).alias("weighted_mean_squared_error"),
        F.round("squared_diff_plus_one", 2).alias("squared_diff_plus_one"),
    )


@query(
    """
    SELECT names.p_brand AS name, greatest(coalesce(max(v.p_size), 1), 1) AS latest_version
    FROM (SELECT DISTINCT p_brand FROM part) names
    LEFT JOIN (SELECT p_brand, p_size FROM part WHERE p_brand NOT LIKE '%5') v USING (p_brand) GROUP BY 1
    """
)
def latest_versions(spark, folder):
    parts = table(spark, folder, "part", "p_brand", "p_size")
    named = parts.select(F.col("p_brand").alias("name"), F.col("p_size").cast("string").alias("version"))
    return latest_version(named.filter("name not like '%5'"), names=named)


PROBABILITY_SQL = """
    SELECT event_id, event_id % 3 AS epoch, event_id % 97 AS batch,
           list_position(['click', 'error', 'purchase', 'signup', 'view'], event_type) - 1 AS label,
           list_transform(range(5), lambda k: (1 + (event_id * (k + 3)) % 7)::DOUBLE) AS w
    FROM events
"""


def probabilities(spark, folder):
    events = table(spark, folder, "events", "event_id", "event_type")
    kinds = F.array(*[F.lit(k) for k in ("click", "error", "purchase", "signup", "view")])
    weights = F.array(*[(1 + F.col("event_id") * (k + 3) % 7).cast("double") for k in range(5)])
    rows = events.select(
        "event_id",
        (F.col("event_id") % 3).alias("epoch"),
        (F.col("event_id") % 97).alias("batch"),
        (F.array_position(kinds, F.col("event_type")) - 1).alias("label"),
        weights.alias("w"),
    )
    total = F.aggregate("w", F.lit(0.0), lambda acc, x: acc + x)
    return rows.withColumn("probability", F.transform("w", lambda x: x / total))


@query(
    f"""
    SELECT epoch, round(avg(-ln(w[label + 1] / list_sum(w))), 9) AS loss,
           round(avg(CASE WHEN list_position(w, list_max(w)) - 1 = label THEN 1.0 ELSE 0.0 END), 9) AS accuracy,
           count(*) AS n_rows, 0 AS n_left_out
    FROM ({PROBABILITY_SQL}) GROUP BY epoch
    """
)
def log_loss_accuracy(spark, folder):
    return _rounded(loss_and_accuracy(probabilities(spark, folder), by=["epoch"]), "loss", "accuracy")


@query(
    f"""
    SELECT epoch, round(avg(l), 9) AS loss, round(sum(c) / sum(n), 9) AS accuracy, sum(n)::BIGINT AS n_rows,
           0 AS n_left_out FROM (
        SELECT epoch, batch, avg(-ln(w[label + 1] / list_sum(w))) AS l, count(*)::DOUBLE AS n,
               sum(CASE WHEN list_position(w, list_max(w)) - 1 = label THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS c
        FROM ({PROBABILITY_SQL}) GROUP BY epoch, batch) GROUP BY epoch
    """
)
def batch_mean_loss(spark, folder):
    found = loss_and_accuracy(probabilities(spark, folder), by=["epoch"], batch="batch")
    return _rounded(found, "loss", "accuracy")


@query(
    """
    WITH s AS (SELECT CASE WHEN vec_id % 11 > 0 THEN label END AS y, CASE WHEN vec_id % 3 > 0 THEN label END AS p FROM embeddings),
    k AS (SELECT y AS cls, count(*) AS support, count(p) AS hits FROM s WHERE y IS NOT NULL GROUP BY y)
    SELECT 'candidate' AS role,
           round(sum(support * 2 * (hits > 0)::INT * (hits / support::DOUBLE) / (1 + hits / support::DOUBLE)) / sum(support), 9) AS f1_score,
           round(sum(support * (hits > 0)::INT) / sum(support)::DOUBLE, 9) AS precision,
           round(sum(hits) / sum(support)::DOUBLE, 9) AS recall, round(sum(hits) / sum(support)::DOUBLE, 9) AS accuracy,
           sum(support)::BIGINT AS n_rows, (SELECT count(*) FROM s WHERE y IS NULL) AS n_unlabelled,
           (SELECT count(*) FROM s WHERE y IS NOT NULL AND p IS NULL) AS n_unpredicted
    FROM k
    """
)
def metrics_with_null_predictions(spark, folder):
    """A model that is right whenever it answers, but answers two times in three."""
    rows = table(spark, folder, "embeddings", "vec_id", "label")
    answered = rows.select(
        F.when(F.col("vec_id") % 11 > 0, F.col("label")).alias("label"),
        F.when(F.col("vec_id") % 3 > 0, F.col("label")).alias("prediction"),
    )
    return _rounded(weighted_metrics(answered), "f1_score", "precision", "recall", "accuracy")


@query(
    f"""
    WITH p AS (SELECT epoch, w, CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 7 = 0 THEN 9 ELSE label END AS y
               FROM ({PROBABILITY_SQL}))
    SELECT epoch, round(avg(-ln(w[y + 1] / list_sum(w))) FILTER (y < 5), 9) AS loss,
           round(avg(CASE WHEN list_position(w, list_max(w)) - 1 = y THEN 1.0 ELSE 0.0 END) FILTER (y < 5), 9) AS accuracy,
           count(*) FILTER (y < 5) AS n_rows, count(*) FILTER (y IS NULL OR y >= 5) AS n_left_out
    FROM p GROUP BY epoch
    """
)
def loss_with_null_labels(spark, folder):
    """Some labels are missing, and some name a class without a probability."""
    label = F.when(F.col("event_id") % 7 == 0, 9).otherwise(F.col("label"))
    rows = probabilities(spark, folder).withColumn("label", F.when(F.col("event_id") % 5 > 0, label))
    return _rounded(loss_and_accuracy(rows, by=["epoch"]), "loss", "accuracy")
