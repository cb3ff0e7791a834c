"""Scans, keys, joins, filters, splits."""

from pyspark.sql import functions as F

from patchloom.functions.keys import build_key, file_name, parse_key, row_id
from patchloom.operators.cleaning import clean_ranges, compute_features, limit_rows, stamp
from patchloom.operators.joins import annotate, unmatched_report
from patchloom.operators.metrics import row_count
from patchloom.operators.splits import hash_split, process_splits, random_split, split_frames
from patchloom.plans.registered import query, table
from patchloom.session import scratch_path
from patchloom.sinks.tables import ensure_schema, overwrite_table
from patchloom.sources.batches import map_batches, materialise
from patchloom.sources.tables import read_indexed_csv, scan_path, scan_sql, scan_table

# Split of a row by the first 32 bits of md5('12345|' || key), 70 to 30.
SPLIT_SQL = (
    "CASE WHEN ('0x' || substr(md5('12345|' || vec_id), 1, 8))::BIGINT < 3006477107 "
    "THEN 'train' ELSE 'validation' END"
)


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def path_scan(spark, folder):
    return scan_path(spark, f"{folder}/orders.parquet", ["o_orderkey", "o_custkey", "o_totalprice"])


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def catalog_table_scan(spark, folder):
    customers = table(spark, folder, "customer")
    ensure_schema(spark, "patchloom_scans")
    location = scratch_path(spark, "customers")
    name = f"patchloom_scans.{location.rsplit('/', 1)[-1].replace('-', '_')}"
    # The second write replaces the rows of the first.
    overwrite_table(customers.filter("c_acctbal <= 0"), name, location=location)
    overwrite_table(customers, name, location=location)
    return scan_table(spark, name)


@query("SELECT vec_id, label, label >= 3 AS high FROM embeddings")
def sql_text_source(spark, folder):
    text = f"SELECT vec_id, label, label >= :low AS high FROM parquet.`{folder}/embeddings.parquet`"
    return scan_sql(spark, text, {"low": 3})


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_ingest(spark, folder):
    customers = table(spark, folder, "customer").withColumn("index", F.col("c_custkey"))
    columns = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
    root = scratch_path(spark, "csv")
    even, odd = customers.filter("c_custkey % 2 = 0"), customers.filter("c_custkey % 2 = 1")
    even.select("index", *columns).write.option("header", True).csv(f"{root}/even")
    odd.select("index", *reversed(columns)).write.option("header", True).csv(f"{root}/odd")
    back = read_indexed_csv(spark, [f"{root}/even", f"{root}/odd"])
    return back.select(F.col("c_custkey").cast("bigint"), *columns[1:])


@query(
    f"""
    SELECT vec_id, {SPLIT_SQL} AS split, len(embedding) AS width,
           round(list_sum(list_transform(embedding, lambda x: abs(x::DOUBLE))), 6) AS magnitude
    FROM embeddings
    """
)
def materialised_split(spark, folder):
    rows = table(spark, folder, "embeddings", "vec_id", "embedding")
    stored = materialise(hash_split(rows, ["vec_id"], {"train": 0.7, "validation": 0.3}), partition_by=("split",))

    def measure(frame):
        return frame[["vec_id", "split"]].assign(
            width=[len(e) for e in frame["embedding"]],
            magnitude=[abs(e.astype("float64")).sum() for e in frame["embedding"]],
        )

    measured = map_batches(stored, measure, "vec_id bigint, split string, width bigint, magnitude double")
    return measured.withColumn("magnitude", F.round("magnitude", 6))


@query("SELECT count(*) AS n_rows FROM lineitem")
def count_rows(spark, folder):
    return row_count(table(spark, folder, "lineitem"))


@query(
    """
    SELECT conv_id, turn, concat_ws('-', conv_id, turn, role) AS key,
           CASE WHEN turn > 0 THEN concat_ws('-', conv_id, turn) END AS strict_key,
           CASE WHEN turn > 0 THEN concat_ws('-', conv_id, turn) ELSE concat_ws('-', conv_id) END AS loose_key,
           sha256(concat_ws('-', conv_id, turn, role)) AS id
    FROM conversations
    """
)
def key_build(spark, folder):
    turns = table(spark, folder, "conversations", "conv_id", "turn", "role")
    later = F.when(F.col("turn") > 0, F.col("turn"))
    return turns.select(
        "conv_id",
        "turn",
        build_key("conv_id", "turn", "role").alias("key"),
        build_key("conv_id", later, strict=True).alias("strict_key"),
        build_key("conv_id", later).alias("loose_key"),
        row_id("conv_id", "turn", "role").alias("id"),
    )


@query(
    r"""
    SELECT page_id, nullif(regexp_extract(url, '(\w+)/(\d+)', 0), '') AS key,
           nullif(regexp_extract(regexp_extract(url, '[^/]*$', 0), '(\d+)', 0), '') AS name_key,
           regexp_extract(url, '[^/]*$', 0) AS file_name
    FROM pages
    """
)
def key_parse(spark, folder):
    pages = table(spark, folder, "pages", "page_id", "url")
    return pages.select(
        "page_id",
        parse_key("url", r"(\w+)/(\d+)", file_name_only=False).alias("key"),
        parse_key("url", r"(\d+)").alias("name_key"),
        file_name("url").alias("file_name"),
    )


@query("SELECT count(*) AS n_rows, count(DISTINCT doc_id) AS n_ids FROM documents")
def random_row_ids(spark, folder):
    ids = table(spark, folder, "documents", "doc_id").select(row_id(random=True).alias("id"))
    return ids.agg(F.count("id").alias("n_rows"), F.count_distinct("id").alias("n_ids"))


@query(
    """
    SELECT sha256(doc_id::VARCHAR) AS id, doc_id, quality AS label, source AS slide_id, text AS content
    FROM labels JOIN documents USING (doc_id)
    """
)
def annotated_content(spark, folder):
    labels = table(spark, folder, "labels", "doc_id", "quality")
    documents = table(spark, folder, "documents", "doc_id", "source", "text")
    return annotate(labels, documents, "doc_id").select(
        row_id("doc_id").alias("id"),
        "doc_id",
        F.col("quality").alias("label"),
        F.col("source").alias("slide_id"),
        F.col("text").alias("content"),
    )


@query(
    """
    WITH l AS (SELECT CASE WHEN toxic = 0 THEN doc_id END AS doc_id FROM labels), r AS (SELECT doc_id FROM documents
         WHERE lang <> 'fr')
    SELECT (SELECT count(*) FROM l WHERE doc_id IN (SELECT doc_id FROM r)) AS left_matched,
           (SELECT count(*) FROM l WHERE doc_id NOT IN (SELECT doc_id FROM r)) AS left_unmatched,
           (SELECT count(*) FROM l WHERE doc_id IS NULL) AS left_without_key,
           (SELECT count(*) FROM r WHERE doc_id IN (SELECT doc_id FROM l WHERE doc_id IS NOT NULL)) AS right_matched,
           (SELECT count(*) FROM r WHERE doc_id NOT IN (SELECT doc_id FROM l WHERE doc_id IS NOT NULL)) AS right_unmatched,
           0::BIGINT AS right_without_key
    """
)
def unmatched_keys(spark, folder):
    labels = table(spark, folder, "labels", "doc_id", "toxic")
    left = labels.select(F.when(F.col("toxic") == 0, F.col("doc_id")).alias("doc_id"))
    right = table(spark, folder, "documents", "doc_id", "lang").filter("lang <> 'fr'")
    return unmatched_report(left, right, "doc_id")


@query(
    """
    SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_tax FROM lineitem
    WHERE l_quantity > 5 AND l_quantity < 40 AND l_extendedprice > 0 AND l_extendedprice < 30000
          AND l_orderkey % 5 <> 0 AND l_orderkey % 7 <> 0
    """
)
def clean_rows(spark, folder):
    lines = table(spark, folder, "lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_tax")
    # Some values of a column without a range are null, some NaN; neither may stay.
    tax = F.when(F.col("l_orderkey") % 7 == 0, float("nan")).otherwise(F.col("l_tax"))
    lines = lines.withColumn("l_tax", F.when(F.col("l_orderkey") % 5 != 0, tax))
    return clean_ranges(lines, {"l_quantity": (5, 40), "l_extendedprice": (0, 30000)})


@query(
    """
    SELECT split, count(*) AS n_rows, sum(vec_id)::BIGINT AS id_sum FROM (
        SELECT vec_id, CASE WHEN h < 2576980378 THEN 'train' WHEN h < 3435973837 THEN 'validation' ELSE 'test' END AS split
        FROM (SELECT vec_id, label, ('0x' || substr(md5('12345|' || vec_id), 1, 8))::BIGINT AS h FROM embeddings)
        WHERE label > 0 AND label < 8) GROUP BY split
    """
)
def cleaned_splits(spark, folder):
    rows = table(spark, folder, "embeddings", "vec_id", "label")
    splits = split_frames(rows, ["vec_id"], {"train": 0.6, "validation": 0.2, "test": 0.2})
    cleaned = process_splits(splits, lambda df: clean_ranges(df, {"label": (0, 8)}))
    tagged = [df.withColumn("split", F.lit(name)) for name, df in cleaned.items()]
    union = tagged[0].unionByName(tagged[1]).unionByName(tagged[2])
    return union.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("vec_id").alias("id_sum"))


@query(f"SELECT vec_id, label, {SPLIT_SQL} AS split FROM embeddings")
def hash_split_rows(spark, folder):
    rows = table(spark, folder, "embeddings", "vec_id", "label")
    return hash_split(rows, ["vec_id"], {"train": 0.7, "validation": 0.3})


@query("SELECT count(*) AS n_rows, count(DISTINCT vec_id) AS n_ids, true AS both_used FROM embeddings")
def random_split_rows(spark, folder):
    rows = table(spark, folder, "embeddings", "vec_id")
    parts = random_split(rows, {"train": 0.7, "validation": 0.3})
    tagged = [df.withColumn("split", F.lit(name)) for name, df in parts.items()]
    return tagged[0].unionByName(tagged[1]).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("vec_id").alias("n_ids"),
        (F.count_distinct("split") == 2).alias("both_used"),
    )


@query("SELECT vec_id, label FROM embeddings ORDER BY label, vec_id LIMIT 20")
def ordered_limit(spark, folder):
    return limit_rows(table(spark, folder, "embeddings", "vec_id", "label"), 20, ["label", "vec_id"])


@query(
    """
    SELECT user_id, event_type, count(*) AS n_events, round(sum(value), 4) AS total
    FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20 12:00:00'
    GROUP BY user_id, event_type
    """
)
def time_range_features(spark, folder):
    def per_user(df):
        return df.groupBy("user_id", "event_type").agg(
            F.count(F.lit(1)).alias("n_events"), F.round(F.sum("value"), 4).alias("total")
        )

    events = table(spark, folder, "events", "ts", "user_id", "event_type", "value")
    return compute_features(events, per_user, "ts", "2024-01-05", "2024-01-20 12:00:00")


@query(
    """
    SELECT vec_id, label, '7' AS model_version, TIMESTAMP '2024-03-01 06:30:00' AS inference_timestamp FROM embeddings
    """
)
def inference_stamp(spark, folder):
    rows = stamp(table(spark, folder, "embeddings", "vec_id", "label"), "7", "2024-03-01 06:30:00")
    return rows.withColumn("inference_timestamp", F.col("inference_timestamp").cast("timestamp_ntz"))
