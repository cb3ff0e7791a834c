"""Training, scoring and the whole feature-to-gate path."""

from dataclasses import replace
from io import BytesIO

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from patchloom.operators.descent import Descent, LastLayer, Run
from patchloom.operators.featurize import share_weights, text_featurizer
from patchloom.operators.foreign import ForeignModel
from patchloom.operators.gate import Threshold
from patchloom.operators.joins import annotate
from patchloom.operators.lookup import FeatureLookup
from patchloom.operators.metrics import CUSTOM_METRICS, custom_metrics, loss_and_accuracy
from patchloom.operators.models import ModelPackage, classifier, coefficients, predict_table, regression, score_batch
from patchloom.operators.splits import TRAIN_VALIDATION_WIDE, split_frames
from patchloom.plans.jobs import embed_and_train, train, train_and_validate, validate, write_features
from patchloom.plans.registered import query, table
from patchloom.plans.registered.features import text_weights
from patchloom.plans.registered.metrics import scored
from patchloom.session import scratch_path
from patchloom.sinks.feature_table import FeatureTable
from patchloom.sinks.tables import ensure_schema, overwrite_table

LABELLED = [FeatureLookup("embeddings", ("embedding",), ("vec_id",))]


def _name(location):
    return "patchloom_models." + location.rsplit("/", 1)[-1].replace("-", "_")


@query(
    """
    WITH s AS (SELECT var_pop(l_quantity) + 1e-4 AS a, var_pop(l_tax * 100) + 1e-4 AS d,
                      covar_pop(l_quantity, l_tax * 100) AS b, covar_pop(l_quantity, l_extendedprice) AS e,
                      covar_pop(l_tax * 100, l_extendedprice) AS f, avg(l_quantity) AS mq, avg(l_tax * 100) AS mt,
                      avg(l_extendedprice) AS my FROM lineitem),
    w AS (SELECT (e * d - f * b) / (a * d - b * b) AS wq, (f * a - e * b) / (a * d - b * b) AS wt, mq, mt, my FROM s)
    SELECT unnest(['quantity', 'tax', 'intercept']) AS term,
           round(unnest([wq, wt, my - wq * mq - wt * mt]), 3) AS coefficient FROM w
    """
)
def linear_fit(spark, folder):
    lines = table(spark, folder, "lineitem", "l_quantity", "l_tax", "l_extendedprice")
    rows = lines.select(
        F.array(F.col("l_quantity"), F.col("l_tax") * 100).alias("features"), F.col("l_extendedprice").alias("label")
    )
    found = coefficients(regression().fit(rows), ["quantity", "tax"])
    return found.withColumn("coefficient", F.round("coefficient", 3))


ORDER_FIT_SQL = """
    t AS (SELECT l_orderkey AS o_orderkey, sum(l_quantity) AS x1, sum(l_extendedprice) / 1000 AS x2
          FROM lineitem GROUP BY l_orderkey),
    j AS (SELECT o_orderkey, o_totalprice / 1000 AS y, x1, x2,
                 ('0x' || substr(md5('12345|' || o_orderkey), 1, 8))::BIGINT < 3006477107 AS used
          FROM orders JOIN t USING (o_orderkey)),
    s AS (SELECT var_pop(x1) + 1e-4 AS a, var_pop(x2) + 1e-4 AS d, covar_pop(x1, x2) AS b, covar_pop(x1, y) AS e,
                 covar_pop(x2, y) AS f, avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my FROM j WHERE used),
    w AS (SELECT (e * d - f * b) / (a * d - b * b) AS w1, (f * a - e * b) / (a * d - b * b) AS w2, m1, m2, my FROM s),
    p AS (SELECT o_orderkey, y, my + w1 * (x1 - m1) + w2 * (x2 - m2) AS p FROM j, w WHERE NOT used)
"""


def _order_regression(spark, folder):
    """Order price from looked-up line totals: the trained model and its sources."""
    orders = table(spark, folder, "orders", "o_orderkey", "o_totalprice")
    base = orders.select("o_orderkey", (F.col("o_totalprice") / 1000).alias("label"))
    lines = table(spark, folder, "lineitem", "l_orderkey", "l_quantity", "l_extendedprice")
    totals = lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.array(F.sum("l_quantity"), F.sum("l_extendedprice") / 1000).alias("features")
    )
    spec = FeatureLookup("line_totals", ("features",), ("o_orderkey",), missing="drop")
    resolve = {"line_totals": totals}.__getitem__
    return train(base, ["o_orderkey"], [spec], regression(), resolve=resolve), resolve


@query(
    f"""
    WITH {ORDER_FIT_SQL} SELECT round(sum((1 / p) * (p - y) * (p - y)) / sum(1 / p), 2) AS weighted_mean_squared_error,
         round(sum((p - y + 1) * (p - y + 1)), 2) AS squared_diff_plus_one FROM p
    """
)
def linear_fit_scores(spark, folder):
    """Regression on looked-up features, scored on held-out orders with the custom metrics."""
    trained, resolve = _order_regression(spark, folder)
    predicted = score_batch(trained.package, trained.held_out, resolve)
    found = custom_metrics(predicted, "label", "prediction", CUSTOM_METRICS)
    return found.select(*[F.round(c, 2).alias(c) for c in found.columns])


@query(
    f"""
    WITH {ORDER_FIT_SQL} SELECT o_orderkey, y AS label, round(p, 6) AS prediction, '12' AS model_version,
         TIMESTAMP '2024-03-01 06:30:00' AS inference_timestamp FROM p
    """
)
def scored_table(spark, folder):
    """Train, save with the lookup, load, score a catalog table by key into another one."""
    trained, resolve = _order_regression(spark, folder)
    path = scratch_path(spark, "package")
    trained.package.save(path)
    package = ModelPackage.load(spark, path)
    ensure_schema(spark, "patchloom_models")
    keys, output = scratch_path(spark, "keys"), scratch_path(spark, "scores")
    overwrite_table(trained.held_out, _name(keys), location=keys)
    scores = predict_table(
        spark, package, _name(keys), _name(output), "12", "2024-03-01 06:30:00", resolve, output
    )
    return scores.withColumns(
        {
            "prediction": F.round("prediction", 6),
            "inference_timestamp": F.col("inference_timestamp").cast("timestamp_ntz"),
        }
    )


@query(
    """
    SELECT vec_id, label, '3' AS model_version, TIMESTAMP '2024-03-01 06:30:00' AS inference_timestamp, true AS of_known_class
    FROM embeddings WHERE ('0x' || substr(md5('12345|' || vec_id), 1, 8))::BIGINT >= 3006477107
    """
)
def train_and_score(spark, folder):
    """Fit on looked-up vectors, score a table by key, stamp, overwrite the output table; which class is predicted is left to the tests."""
    vectors = table(spark, folder, "embeddings")
    base = vectors.select("vec_id", "label")
    resolve = {"embeddings": vectors.select("vec_id", "embedding")}.__getitem__
    trained = train(base, ["vec_id"], LABELLED, classifier("embedding"), exclude=["vec_id"], resolve=resolve)
    ensure_schema(spark, "patchloom_models")
    keys, output = scratch_path(spark, "keys"), scratch_path(spark, "scores")
    overwrite_table(trained.held_out, _name(keys), location=keys)
    scores = predict_table(
        spark, trained.package, _name(keys), _name(output), "3", "2024-03-01 06:30:00", resolve, output
    )
    known = F.coalesce(F.col("prediction").isin([float(k) for k in range(10)]), F.lit(False))
    return scores.select(
        "vec_id", "label", "model_version", F.col("inference_timestamp").cast("timestamp_ntz").alias("inference_timestamp"), known.alias("of_known_class")
    )


def _batch_sql(key, batches):
    return f"('0x' || substr(md5('12345|batch|' || {key}), 1, 8))::BIGINT % {batches}"


def _judged_sql(weights, rows):
    """Probability of every class, and on each row its loss and whether the likeliest class is its own."""
    each = "OVER (PARTITION BY id)"
    return f"""
        SELECT id, y, b, k, exp(z - top) / sum(exp(z - top)) {each} AS p,
               top + ln(sum(exp(z - top)) {each}) - max(CASE WHEN k = y THEN z END) {each} AS loss,
               row_number() OVER (PARTITION BY id ORDER BY z DESC, k) = 1 AND k = y AS hit
        FROM (SELECT *, max(z) {each} AS top FROM (
            SELECT r.id, r.y, r.b, w.k, sum(x.v * w.w) AS z FROM r JOIN x USING (id) JOIN {weights} w USING (d) WHERE {rows} GROUP BY ALL))
    """


def _descent_sql(rows, numbers, dims, classes, settings, validated=True):
    """The steps of a run, one after the other: w0, w1, ... and ``h``, its history; and the name of the last weights.

    ``rows`` gives (id, y, b, split), ``numbers`` (id, d, v) with 1 at ``d = dims``.
    """
    parts = [
        f"r AS MATERIALIZED ({rows})",
        f"x AS MATERIALIZED ({numbers})",
        f"w0 AS MATERIALIZED (SELECT k, d, 0.0::DOUBLE AS w, 0.0::DOUBLE AS u FROM unnest(range({classes})) a(k), unnest(range({dims + 1})) b(d))",
    ]
    step, lines = 0, []
    for epoch in range(1, settings.epochs + 1):
        rate = settings.learning_rate * settings.decay_by ** ((epoch - 1) // settings.decay_every)
        judged = []
        for batch in settings.order(epoch):
            parts.append(f"p{step} AS MATERIALIZED ({_judged_sql(f'w{step}', f"r.split = 'train' AND r.b = {batch}")})")
            judged.append(f"SELECT * FROM p{step}")
            moved = f"{settings.momentum!r}::DOUBLE * w.u + g.g"
            parts.append(f"""w{step + 1} AS MATERIALIZED (
                SELECT w.k, w.d, w.w - {rate!r}::DOUBLE * ({moved}) AS w, {moved} AS u FROM w{step} w JOIN (
                    SELECT p.k, x.d, sum((p.p - (p.k = p.y)::INTEGER) * x.v) / count(*) AS g FROM p{step} p JOIN x USING (id) GROUP BY p.k, x.d) g USING (k, d))""")
            step += 1
        lines.append(f"""SELECT {epoch} AS epoch, 'train' AS split, {rate!r}::DOUBLE AS learning_rate, avg(loss) FILTER (k = 0) AS loss,
            (count(*) FILTER (hit))::DOUBLE / count(*) FILTER (k = 0) AS accuracy, count(*) FILTER (k = 0) AS n_rows FROM ({" UNION ALL ".join(judged)})""")
        if validated:
            lines.append(f"""SELECT {epoch}, 'validation', {rate!r}::DOUBLE, avg(l), sum(h) / sum(n), sum(n)::BIGINT FROM (
                SELECT b, avg(loss) FILTER (k = 0) AS l, (count(*) FILTER (hit))::DOUBLE AS h, count(*) FILTER (k = 0) AS n
                FROM ({_judged_sql(f"w{step}", "r.split = 'validation'")}) GROUP BY b)""")
    return ",\n".join([*parts, f"h AS ({' UNION ALL '.join(lines)})"]), f"w{step}"


VECTOR_DESCENT = Descent(epochs=4, batches=3, learning_rate=4.0, decay_every=2, classes=10)
VECTOR_DESCENT_SQL, VECTOR_WEIGHTS = _descent_sql(
    f"""SELECT vec_id AS id, label AS y, {_batch_sql('vec_id', 3)} AS b,
        CASE WHEN ('0x' || substr(md5('12345|' || vec_id), 1, 8))::BIGINT < 3865470566 THEN 'train' ELSE 'validation' END AS split FROM embeddings""",
    "SELECT vec_id AS id, i AS d, CASE WHEN i < 64 THEN embedding[i + 1]::DOUBLE ELSE 1.0 END AS v FROM embeddings, unnest(range(65)) t(i)",
    64, 10, VECTOR_DESCENT,
)


def _vector_run(spark, folder, epochs):
    """A layer on the vectors, trained in runs that stop after the given epochs, each going on from the one before."""
    vectors = table(spark, folder, "embeddings", "vec_id", "label", "embedding")
    parts = split_frames(vectors, ["vec_id"], TRAIN_VALIDATION_WIDE)
    path = scratch_path(spark, "descent")
    for last in epochs:
        run = Run(spark, path)
        asked = replace(VECTOR_DESCENT, epochs=last)
        settings, dims = run.prepare(parts["train"], parts["validation"], ["vec_id"], asked, "embedding", "label")
        run.advance(settings, dims, validated=True)
    run.drop_rows()
    return run


@query(
    f"""
    WITH {VECTOR_DESCENT_SQL}
    SELECT epoch, split, learning_rate, round(loss, 6) AS loss, round(accuracy, 6) AS accuracy, n_rows, 0::BIGINT AS n_left_out FROM h
    """
)
def head_history(spark, folder):
    """A last layer by mini-batch descent: a row per epoch and split, of a run that stopped after two epochs and went on."""
    found = _vector_run(spark, folder, (2, 4)).history()
    return found.withColumns({"loss": F.round("loss", 6), "accuracy": F.round("accuracy", 6)})


@query(f"WITH {VECTOR_DESCENT_SQL} SELECT k::INTEGER AS class, d::INTEGER AS pos, round(w, 6) + 0.0 AS weight FROM {VECTOR_WEIGHTS}")
def head_weights(spark, folder):
    """What twelve steps of momentum and decay make of the layer's weights; the intercept comes last."""
    weights = _vector_run(spark, folder, (4,)).weights(4)
    rows = [(k, d, float(w)) for k, line in enumerate(weights) for d, w in enumerate(line)]
    return spark.createDataFrame(rows, "class int, pos int, weight double").withColumn("weight", F.round("weight", 6) + 0.0)


TEXT_DESCENT = Descent(epochs=3, batches=4, learning_rate=0.2, classes=2)


def _text_descent_sql(key):
    """Quality learnt from the text features per character, rows named by ``key``; what the split holds out is not trained on."""
    return _descent_sql(
        f"""SELECT {key} AS id, quality AS y, {_batch_sql(key, 4)} AS b,
            CASE WHEN ('0x' || substr(md5('12345|' || {key}), 1, 8))::BIGINT < 3006477107 THEN 'train' ELSE 'held out' END AS split
            FROM labels JOIN documents USING (doc_id)""",
        f"""SELECT {key} AS id, d, CASE WHEN d < 8 THEN coalesce(s, 0.0) / greatest(n, 1) ELSE 1.0 END AS v
            FROM (SELECT doc_id, length(text) AS n, unnest(range(9)) AS d FROM documents) LEFT JOIN (
                SELECT doc_id, j AS d, sum(n * ((c * 7 + j * 13) % 17 - 8)) / 8.0::DOUBLE AS s FROM (
                    SELECT doc_id, (cs[k] * 31 + cs[k + 1]) % 64 AS c, count(*) AS n FROM (
                        SELECT doc_id, cs, unnest(range(1, len(cs))) AS k FROM (
                            SELECT doc_id, list_transform(string_split(text, ''), lambda c: unicode(c)::BIGINT) AS cs FROM documents)) GROUP BY ALL),
                    unnest(range(8)) t(j) GROUP BY doc_id, j) USING (doc_id, d)""",
        8, 2, TEXT_DESCENT, validated=False,
    )


def _per_character(embed):
    return lambda text: F.transform(embed(text), lambda v: v.cast("double") / F.greatest(F.length(text), F.lit(1)))


def _text_layer(key):
    return Pipeline(stages=[LastLayer(keys=[key], epochs=3, batches=4, learningRate=0.2, validationShare=0.0, keep="last")])


TEXT_DESCENT_SQL, TEXT_WEIGHTS = _text_descent_sql("doc_id")


@query(
    f"""
    WITH {TEXT_DESCENT_SQL}, judged AS ({_judged_sql(TEXT_WEIGHTS, "r.split = 'held out'")})
    SELECT round(avg(loss) FILTER (k = 0), 6) AS loss, round((count(*) FILTER (hit))::DOUBLE / count(*) FILTER (k = 0), 6) AS accuracy,
           count(*) FILTER (k = 0) AS n_rows FROM judged
    """
)
def embedding_head(spark, folder):
    """Frozen text embedding with a layer trained on top; loss and accuracy on held-out rows."""
    labels = table(spark, folder, "labels", "doc_id", "quality").withColumnRenamed("quality", "label")
    documents = table(spark, folder, "documents", "doc_id", "text")
    embed = _per_character(text_featurizer(share_weights(spark, text_weights())))
    held_out = embed_and_train(annotate(labels, documents, "doc_id"), embed, "text", ["doc_id"], pipeline=_text_layer("doc_id"))
    return loss_and_accuracy(held_out, prediction="prediction").select(
        F.round("loss", 6).alias("loss"), F.round("accuracy", 6).alias("accuracy"), "n_rows"
    )


@query(
    """
    WITH s AS (SELECT label, CASE WHEN vec_id % 5 = 0
               THEN list_position(embedding[1:32], list_max(embedding[1:32])) - 1 ELSE label END AS p FROM embeddings),
    m AS (SELECT sum((p - label + 1) * (p - label + 1))::DOUBLE AS d,
                 sum(CASE WHEN p = label THEN 1 ELSE 0 END) / count(*)::DOUBLE AS a FROM s)
    SELECT 'accuracy' AS metric_name, round(a, 6) AS candidate, a >= 0.8 AS passed FROM m
    UNION ALL SELECT 'squared_diff_plus_one', round(d, 6), d <= 10 FROM m
    """
)
def dry_run_gate(spark, folder):
    """A failing rule is reported and does not raise in a dry run."""
    rules = [Threshold("accuracy", 0.8), Threshold("squared_diff_plus_one", 10, higher_is_better=False)]
    custom = {"squared_diff_plus_one": CUSTOM_METRICS["squared_diff_plus_one"]}
    result = validate(scored(spark, folder), rules=rules, run_mode="dry_run", custom=custom)
    ruled = result.report.filter("threshold is not null")
    return ruled.select("metric_name", F.round("candidate", 6).alias("candidate"), "passed")


GATE_DESCENT_SQL, GATE_WEIGHTS = _text_descent_sql("sha256(doc_id::VARCHAR)")


@query(
    f"""
    WITH {GATE_DESCENT_SQL}, judged AS ({_judged_sql(GATE_WEIGHTS, "r.split = 'held out'")}),
    told AS (SELECT id, y, max_by(k, p) AS k FROM judged GROUP BY id, y),
    n AS (SELECT c, count(*) FILTER (y = c)::DOUBLE AS own, count(*) FILTER (k = c)::DOUBLE AS said, count(*) FILTER (y = c AND k = c)::DOUBLE AS hit
          FROM told, unnest(range(2)) t(c) GROUP BY c),
    m AS (SELECT sum(own * CASE WHEN said > 0 THEN hit / said ELSE 0 END) / sum(own) AS precision, sum(hit) / sum(own) AS recall,
                 sum(own * CASE WHEN hit > 0 THEN 2 * hit / (said + own) ELSE 0 END) / sum(own) AS f1_score, sum(hit) / sum(own) AS accuracy FROM n),
    long AS (UNPIVOT m ON f1_score, precision, recall, accuracy INTO NAME metric_name VALUE candidate)
    SELECT metric_name, round(candidate, 6) AS candidate, NULL::DOUBLE AS baseline, threshold, higher_is_better, candidate >= threshold AS passed
    FROM long LEFT JOIN (VALUES ('accuracy', 0.8::DOUBLE, true), ('f1_score', 0.5::DOUBLE, true)) v(metric_name, threshold, higher_is_better)
        USING (metric_name)
    """
)
def features_to_gate(spark, folder):
    """The whole path: annotate, featurize, upsert, split, look up, fit, score, measure, gate."""
    labels = table(spark, folder, "labels", "doc_id", "quality")
    documents = table(spark, folder, "documents", "doc_id", "text")
    embed = _per_character(text_featurizer(share_weights(spark, text_weights())))
    annotated = annotate(labels, documents, "doc_id").withColumn("id", F.sha2(F.col("doc_id").cast("string"), 256))
    rows = annotated.select("id", F.col("quality").alias("label"), embed("text").alias("features"))

    location = scratch_path(spark, "document_features")
    name = _name(location)
    features = write_features(rows, FeatureTable(name, ("id",), buckets=8), location)
    result = train_and_validate(
        features.select("id", "label"),
        ["id"],
        [FeatureLookup(name, ("features",), ("id",), missing="error")],
        scratch_path(spark, "package"),
        run_mode="dry_run",
        pipeline=_text_layer("id"),
    )
    return result.report.withColumn("candidate", F.round("candidate", 6))


@query(
    "SELECT o_orderkey, o_orderkey % 3 > 0 AS scored FROM orders"
)
def scored_table_missing_keys(spark, folder):
    """A third of the keys have no features: their rows stay, without a prediction."""
    orders = table(spark, folder, "orders", "o_orderkey", "o_totalprice").withColumn("label", F.col("o_totalprice") / 1000)
    features = orders.select("o_orderkey", F.array("label").alias("features"))
    base = orders.select("o_orderkey", "label")
    lookups = [FeatureLookup("orders", ("features",), ("o_orderkey",))]
    trained = train(base, ["o_orderkey"], lookups, regression(), resolve={"orders": features}.__getitem__)
    known = {"orders": features.filter("o_orderkey % 3 > 0")}
    found = score_batch(trained.package, base.select("o_orderkey"), known.__getitem__)
    return found.select("o_orderkey", F.col("prediction").isNotNull().alias("scored"))


SPLIT_SQL = "('0x' || substr(md5('12345|' || o_orderkey), 1, 8))::BIGINT"


@query(
    f"""
    SELECT o_orderkey, CASE WHEN {SPLIT_SQL} < 3435973837 THEN 'validation' ELSE 'test' END AS split
    FROM orders WHERE {SPLIT_SQL} >= 2576980378
    """
)
def three_way_training_split(spark, folder):
    """What is held out by three weights: both parts, each row once."""
    orders = table(spark, folder, "orders", "o_orderkey", "o_totalprice").withColumn("label", F.col("o_totalprice") / 1000)
    features = orders.select("o_orderkey", F.array("label").alias("features"))
    trained = train(
        orders.select("o_orderkey", "label"), ["o_orderkey"], [FeatureLookup("orders", ("features",), ("o_orderkey",))],
        regression(), weights={"train": 0.6, "validation": 0.2, "test": 0.2}, resolve={"orders": features}.__getitem__,
    )
    parts = [rows.select("o_orderkey", F.lit(name).alias("split")) for name, rows in trained.splits.items()]
    return parts[0].unionByName(parts[1])


@query(
    """
    WITH hidden AS (
        SELECT vec_id, label, j, list_sum(list_transform(range(64), lambda i: embedding[i + 1]::DOUBLE * ((i * 5 + j * 3) % 7 - 3))) + j / 8.0::DOUBLE AS h
        FROM embeddings, unnest(range(6)) t(j)),
    scored AS (SELECT vec_id, label, sum(greatest(h, 0) * (j - 2)) + 0.25 AS p FROM hidden GROUP BY vec_id, label)
    SELECT vec_id, label, CASE WHEN vec_id % 9 > 0 THEN round(p, 6) END AS prediction FROM scored
    """
)
def foreign_package(spark, folder):
    """A network from elsewhere, packaged with its lookup, saved, loaded and applied to a table of keys; a ninth of them have no features."""
    vectors = table(spark, folder, "embeddings", "vec_id", "label", "embedding")
    i, j = np.meshgrid(np.arange(64), np.arange(6), indexing="ij")
    layers = BytesIO()
    np.savez(layers, w0=(i * 5 + j * 3) % 7 - 3.0, b0=np.arange(6) / 8, w1=np.arange(6)[:, None] - 2.0, b1=np.array([0.25]))
    model = ForeignModel.package(spark, {"layers.npz": layers.getvalue()}, "patchloom.operators.foreign:numpy_layers", "embedding")
    path = scratch_path(spark, "package")
    ModelPackage(PipelineModel(stages=[model]), tuple(LABELLED)).save(path)
    resolve = {"embeddings": vectors.filter("vec_id % 9 > 0").select("vec_id", "embedding")}.__getitem__
    found = score_batch(ModelPackage.load(spark, path), vectors.select("vec_id", "label"), resolve)
    return found.withColumn("prediction", F.round("prediction", 6))
