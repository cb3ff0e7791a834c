"""Time and encoding features, vectors, pixels, featurizers."""

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from patchloom.functions.encode import ColumnEncoder, category_places, fit_categories, fit_moments, one_hot, standard_scale, with_places
from patchloom.functions.pixels import normalize_channels, scale_to_unit
from patchloom.functions.times import (
    ceil_minutes,
    ceil_minutes_epoch,
    day_of_week,
    duration_minutes,
    hour_of_day,
)
from patchloom.functions.vectors import DenseVectorizer, argmax
from patchloom.operators.featurize import predictor, share_weights, text_featurizer
from patchloom.operators.wide import WideEncoder
from patchloom.plans.registered import query, table
from patchloom.session import scratch_path
from patchloom.sources.tables import explode_array


def _ceil_sql(minutes):
    return f"""
    SELECT event_id, e AS epoch, make_timestamp(e * 1000000) AS rounded FROM (
        SELECT event_id, epoch(date_trunc('hour', ts))::BIGINT
               + ((epoch_us(ts) - epoch_us(date_trunc('hour', ts)) + {minutes * 60_000_000 - 1}) // {minutes * 60_000_000})
               * {minutes * 60} AS e
        FROM events)
    """


def _ceil(spark, folder, minutes):
    return table(spark, folder, "events", "event_id", "ts").select(
        "event_id",
        ceil_minutes_epoch("ts", minutes).alias("epoch"),
        ceil_minutes("ts", minutes, zoneless=True).alias("rounded"),
    )


@query(_ceil_sql(15))
def ceil_minutes_15(spark, folder):
    return _ceil(spark, folder, 15)


@query(_ceil_sql(30))
def ceil_minutes_30(spark, folder):
    return _ceil(spark, folder, 30)


@query(_ceil_sql(7))
def ceil_minutes_7(spark, folder):
    return _ceil(spark, folder, 7)


@query(
    """
    SELECT event_id, (isodow(ts) - 1)::INTEGER AS pickup_dow, hour(ts)::INTEGER AS pickup_hour FROM events
    """
)
def calendar_features(spark, folder):
    return table(spark, folder, "events", "event_id", "ts").select(
        "event_id", day_of_week("ts").alias("pickup_dow"), hour_of_day("ts").alias("pickup_hour")
    )


TRIPS_SQL = """
    SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice,
           o_orderdate + to_minutes(CAST((l_orderkey * 37) % 1440 AS BIGINT)) AS pickup,
           l_shipdate + to_minutes(CAST((l_linenumber * 191 + l_partkey) % 1440 AS BIGINT)) AS dropoff
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""


def trips(spark, folder):
    """Order lines as trips; the dates get a time of day from the keys."""
    lines = table(
        spark, folder, "lineitem",
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate",
    )
    orders = table(spark, folder, "orders", "o_orderkey", "o_orderdate")
    joined = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])

    def shifted(day, minutes):
        return F.timestamp_add("MINUTE", minutes, F.col(day)).cast("timestamp_ntz")

    return joined.select(
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        "l_extendedprice",
        shifted("o_orderdate", (F.col("l_orderkey") * 37) % 1440).alias("pickup"),
        shifted("l_shipdate", (F.col("l_linenumber") * 191 + F.col("l_partkey")) % 1440).alias("dropoff"),
    )


@query(
    f"""
    SELECT l_orderkey, l_linenumber, l_extendedprice, (epoch_us(dropoff) - epoch_us(pickup)) / 60000000.0::DOUBLE AS minutes
    FROM ({TRIPS_SQL})
    """
)
def duration_in_minutes(spark, folder):
    return trips(spark, folder).select(
        "l_orderkey", "l_linenumber", "l_extendedprice", duration_minutes("pickup", "dropoff").alias("minutes")
    )


@query(
    f"""
    SELECT l_orderkey, l_linenumber, l_quantity,
           date_trunc('hour', pickup) + to_minutes(((minute(pickup) + 14) // 15) * 15) AS rounded_pickup,
           date_trunc('hour', dropoff) + to_minutes(((minute(dropoff) + 29) // 30) * 30) AS rounded_dropoff
    FROM ({TRIPS_SQL})
    """
)
def scoring_input(spark, folder):
    rounded = trips(spark, folder).withColumns(
        {
            "rounded_pickup": ceil_minutes("pickup", 15, zoneless=True),
            "rounded_dropoff": ceil_minutes("dropoff", 30, zoneless=True),
        }
    )
    return rounded.drop("pickup", "dropoff", "l_extendedprice")


@query(
    """
    SELECT which, category, (row_number() OVER (PARTITION BY which ORDER BY category) - 1)::INTEGER AS pos FROM (
        SELECT DISTINCT 'event_type' AS which, event_type AS category FROM events
        UNION ALL SELECT DISTINCT 'hour', lpad(hour(ts)::VARCHAR, 2, '0') FROM events)
    """
)
def category_lists(spark, folder):
    events = table(spark, folder, "events", "event_type", "ts")
    rows = events.select("event_type", F.lpad(hour_of_day("ts").cast("string"), 2, "0").alias("hour"))
    found = fit_categories(rows, ["event_type", "hour"])
    flat = [(which, value, pos) for which, values in found.items() for pos, value in enumerate(values)]
    return spark.createDataFrame(flat, "which string, category string, pos int")


@query(
    """
    WITH cats AS (SELECT list_sort(list(DISTINCT event_type)) AS cs FROM events)
    SELECT event_id, i::INTEGER AS pos, CASE WHEN cs[i + 1] = event_type THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS value
    FROM events, cats, unnest(range(5)) t(i)
    """
)
def one_hot_rows(spark, folder):
    events = table(spark, folder, "events", "event_id", "event_type")
    categories = fit_categories(events, ["event_type"])["event_type"]
    encoded = events.select("event_id", one_hot(F.col("event_type"), categories).alias("hot"))
    return explode_array(encoded, ["event_id"], "hot")


@query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey,
           round((l_quantity - (SELECT avg(l_quantity) FROM lineitem)) / (SELECT stddev_pop(l_quantity) FROM lineitem), 6)
             AS quantity,
           round((l_extendedprice - (SELECT avg(l_extendedprice) FROM lineitem))
             / (SELECT stddev_pop(l_extendedprice) FROM lineitem), 6) AS price
    FROM lineitem
    """
)
def standard_scale_rows(spark, folder):
    lines = table(spark, folder, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    moments = fit_moments(lines, ["l_quantity", "l_extendedprice"])
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.round(standard_scale(F.col("l_quantity"), moments["l_quantity"]), 6).alias("quantity"),
        F.round(standard_scale(F.col("l_extendedprice"), moments["l_extendedprice"]), 6).alias("price"),
    )


@query(
    f"""
    WITH t AS (
        SELECT l_orderkey, l_linenumber, l_extendedprice, hour(pickup)::INTEGER AS h, (isodow(pickup) - 1)::INTEGER AS d,
               l_quantity AS dist, (epoch_us(dropoff) - epoch_us(pickup)) / 60000000.0::DOUBLE AS dur
        FROM ({TRIPS_SQL})),
    s AS (SELECT list_sort(list(DISTINCT h)) AS hs, list_sort(list(DISTINCT d)) AS ds, avg(dist) AS m1,
                 stddev_pop(dist) AS s1, avg(dur) AS m2, stddev_pop(dur) AS s2 FROM t)
    SELECT l_orderkey, l_linenumber, l_extendedprice, len(hs) + len(ds) + 2 AS width,
           list_position(hs, h) - 1 AS hour_place, len(hs) + list_position(ds, d) - 1 AS day_place,
           round((dist - m1) / s1, 6) AS distance, round((dur - m2) / s2, 6) AS duration
    FROM t, s
    """
)
def column_transform(spark, folder):
    timed = trips(spark, folder).select(
        "l_orderkey",
        "l_linenumber",
        "l_extendedprice",
        hour_of_day("pickup").alias("pickup_hour"),
        day_of_week("pickup").alias("pickup_dow"),
        F.col("l_quantity").alias("trip_distance"),
        duration_minutes("pickup", "dropoff").alias("trip_duration"),
    )
    encoder = ColumnEncoder.fit(timed, ["pickup_hour", "pickup_dow"], ["trip_distance", "trip_duration"])
    encoded = encoder.transform(timed, ["l_orderkey", "l_linenumber", "l_extendedprice"])
    hours = len(encoder.categories["pickup_hour"])
    days = len(encoder.categories["pickup_dow"])
    features = F.col("features")
    return encoded.select(
        "l_orderkey",
        "l_linenumber",
        "l_extendedprice",
        F.size(features).cast("bigint").alias("width"),
        (F.array_position(F.slice(features, 1, hours), 1.0) - 1).cast("int").alias("hour_place"),
        (F.array_position(F.slice(features, hours + 1, days), 1.0) + hours - 1).cast("bigint").alias("day_place"),
        F.round(F.get(features, F.lit(hours + days)), 6).alias("distance"),
        F.round(F.get(features, F.lit(hours + days + 1)), 6).alias("duration"),
    )


@query(
    """
    SELECT vec_id, (list_position(embedding, list_max(embedding)) - 1)::INTEGER AS prediction, label FROM embeddings
    """
)
def argmax_class(spark, folder):
    return table(spark, folder, "embeddings").select("vec_id", argmax("embedding").alias("prediction"), "label")


@query(
    """
    SELECT vec_id, i::INTEGER AS pos,
           round(((floor((embedding[i + 1]::DOUBLE + 1) * 127.5) / 255.0::DOUBLE)
             - [0.485::DOUBLE, 0.456::DOUBLE, 0.406::DOUBLE][(i % 3 + 1)::INTEGER])
             / [0.229::DOUBLE, 0.224::DOUBLE, 0.225::DOUBLE][(i % 3 + 1)::INTEGER], 6) AS value
    FROM embeddings, unnest(range(64)) t(i)
    """
)
def pixel_normalize(spark, folder):
    grey = F.transform("embedding", lambda x: F.floor((x.cast("double") + 1) * 127.5).cast("double"))
    scaled = table(spark, folder, "embeddings", "vec_id", "embedding").select(
        "vec_id", normalize_channels(scale_to_unit(grey)).alias("scaled")
    )
    rows = explode_array(scaled, ["vec_id"], "scaled")
    return rows.withColumn("value", F.round("value", 6))


@query(
    """
    SELECT vec_id, label, len(embedding) + 1 AS width,
           round(label + list_sum(list_transform(embedding, lambda x: abs(x::DOUBLE))), 6) AS magnitude
    FROM embeddings
    """
)
def dense_vectors(spark, folder):
    stages = [
        DenseVectorizer(inputCol="embedding", outputCol="dense_features"),
        VectorAssembler(inputCols=["dense_features", "label"], outputCol="feature", handleInvalid="error"),
    ]
    rows = table(spark, folder, "embeddings")
    vectors = Pipeline(stages=stages).fit(rows).transform(rows)
    values = vector_to_array("feature")
    total = F.aggregate(values, F.lit(0.0), lambda acc, x: acc + F.abs(x))
    return vectors.select(
        "vec_id", "label", F.size(values).cast("bigint").alias("width"), F.round(total, 6).alias("magnitude")
    )


TEXT_BUCKETS, TEXT_WIDTH = 64, 8


def text_weights():
    """A fixed projection; eighths keep every sum exact."""
    rows, columns = np.meshgrid(np.arange(TEXT_BUCKETS), np.arange(TEXT_WIDTH), indexing="ij")
    return ((rows * 7 + columns * 13) % 17 - 8) / 8.0


@query(
    """
    WITH chars AS (SELECT doc_id, list_transform(string_split(text, ''), lambda c: unicode(c)::BIGINT) AS cs FROM documents),
    pairs AS (SELECT doc_id, (cs[k] * 31 + cs[k + 1]) % 64 AS b
              FROM (SELECT doc_id, cs, unnest(range(1, len(cs))) AS k FROM chars)),
    counts AS (SELECT doc_id, b, count(*) AS n FROM pairs GROUP BY doc_id, b),
    summed AS (SELECT doc_id, j, sum(n * ((b * 7 + j * 13) % 17 - 8)) / 8.0::DOUBLE AS value
               FROM counts, unnest(range(8)) t(j) GROUP BY doc_id, j)
    SELECT doc_id, j::INTEGER AS pos, coalesce(value, 0.0::DOUBLE) AS value
    FROM (SELECT doc_id, j FROM documents, unnest(range(8)) t(j)) LEFT JOIN summed USING (doc_id, j)
    """
)
def text_featurize(spark, folder):
    embed = text_featurizer(share_weights(spark, text_weights()))
    documents = table(spark, folder, "documents", "doc_id", "text")
    embedded = documents.select("doc_id", embed("text").alias("features"))
    rows = explode_array(embedded, ["doc_id"], "features")
    return rows.withColumn("value", F.col("value").cast("double"))


@query(
    """
    SELECT vec_id, round(0.5::DOUBLE + list_sum(list_transform(range(64),
           lambda i: embedding[i + 1]::DOUBLE * ((i % 5) - 2))), 6) AS prediction
    FROM embeddings
    """
)
def foreign_model_prediction(spark, folder):
    weights = share_weights(spark, (np.arange(64) % 5 - 2).astype(float))
    predict = predictor(lambda: weights.value, lambda w, batch: batch.astype(float) @ w + 0.5)
    rows = table(spark, folder, "embeddings", "vec_id", "embedding")
    return rows.select("vec_id", F.round(predict("embedding"), 6).alias("prediction"))


@query("SELECT o_orderkey, o_custkey, dense_rank() OVER (ORDER BY o_orderkey) - 1 AS place FROM orders")
def category_places_large(spark, folder):
    """One category per order: numbered in a table and joined, with nothing on the driver."""
    orders = table(spark, folder, "orders", "o_orderkey", "o_custkey")
    return with_places(orders, "o_orderkey", category_places(orders, "o_orderkey"))


@query(
    """
    WITH places AS (SELECT l_orderkey, row_number() OVER (ORDER BY l_orderkey) - 1 AS place FROM (SELECT DISTINCT l_orderkey FROM lineitem)),
    flags AS (SELECT l_returnflag, row_number() OVER (ORDER BY l_returnflag) - 1 AS flag FROM (SELECT DISTINCT l_returnflag FROM lineitem)),
    s AS (SELECT (SELECT count(*) FROM places) AS n, (SELECT count(*) FROM flags) AS m, avg(l_quantity) AS mean, stddev_pop(l_quantity) AS std FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey, (n + m + 1)::INTEGER AS width, place::INTEGER AS order_place, (n + flag)::INTEGER AS flag_place,
           2::BIGINT AS n_ones, round((l_quantity - mean) / std, 6) AS quantity
    FROM lineitem JOIN places USING (l_orderkey) JOIN flags USING (l_returnflag), s
    """
)
def column_transform_wide(spark, folder):
    """A category for every order, one for every flag and a scaled number as a sparse vector, by a saved and loaded pipeline."""
    lines = table(spark, folder, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_quantity")
    encoder = WideEncoder(inputCols=["l_orderkey", "l_returnflag"], scaleCols=["l_quantity"])
    path = scratch_path(spark, "encoder")
    Pipeline(stages=[encoder]).fit(lines).save(path)
    encoded = PipelineModel.load(path).transform(lines)
    # A vector's parts, as Spark writes them.
    parts = F.from_json(F.to_json(F.struct("features")), "features struct<size int, indices array<int>, values array<double>>")["features"]
    rows = encoded.withColumn("_parts", parts).select("l_orderkey", "l_linenumber", "l_partkey", "_parts.size", "_parts.indices", "_parts.values")
    scaled = F.element_at(F.map_from_arrays("indices", "values"), F.col("size") - 1)
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.col("size").alias("width"),
        F.get("indices", F.lit(0)).alias("order_place"),
        F.get("indices", F.lit(1)).alias("flag_place"),
        F.size(F.filter(F.slice("values", 1, 2), lambda v: v == 1)).cast("bigint").alias("n_ones"),
        F.round(F.coalesce(scaled, F.lit(0.0)), 6).alias("quantity"),
    )
