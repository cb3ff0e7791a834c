"""Feature tables and feature lookups."""

from pyspark.sql import functions as F

from patchloom.operators.lookup import FeatureLookup, point_in_time_lookup, with_features
from patchloom.operators.skew import hot_keys, lookup_join
from patchloom.plans.jobs import write_features
from patchloom.plans.registered import query, table
from patchloom.session import scratch_path
from patchloom.sinks.feature_table import FeatureTable, merge_rows
from patchloom.sinks.versions import VersionedTable

UPSERT_SQL = """
    WITH target AS (SELECT c_custkey, c_acctbal, c_mktsegment FROM customer WHERE c_custkey % 3 <> 0),
    updates AS (SELECT c_custkey, c_acctbal + 100 AS c_acctbal, 'UPDATED' AS c_mktsegment
                FROM customer WHERE c_custkey % 4 = 0)
    SELECT * FROM updates
    UNION ALL SELECT * FROM target WHERE c_custkey NOT IN (SELECT c_custkey FROM updates)
"""


def _upsert_input(spark, folder):
    customers = table(spark, folder, "customer", "c_custkey", "c_acctbal", "c_mktsegment")
    updates = customers.filter("c_custkey % 4 = 0").withColumns(
        {"c_acctbal": F.col("c_acctbal") + 100, "c_mktsegment": F.lit("UPDATED")}
    )
    return customers.filter("c_custkey % 3 <> 0"), updates


@query(UPSERT_SQL)
def upsert_by_key(spark, folder):
    target, updates = _upsert_input(spark, folder)
    return merge_rows(target, updates, ["c_custkey"])


@query(
    f"""
    SELECT 1 AS version, c_custkey, c_acctbal, c_mktsegment FROM customer WHERE c_custkey % 3 <> 0
    UNION ALL SELECT 2, * FROM ({UPSERT_SQL})
    UNION ALL SELECT 3, c_custkey, c_acctbal + 100, 'UPDATED' FROM customer WHERE c_custkey % 4 = 0
    """
)
def versioned_upsert(spark, folder):
    """A reader on version 1 while version 2 is written, version 2, and (as 3) what changed between them."""
    target, updates = _upsert_input(spark, folder)
    held = VersionedTable.create(target, FeatureTable("customers", ("c_custkey",), buckets=8), scratch_path(spark, "versions"))
    held.upsert(target)
    pinned = held.read()
    held.upsert(updates)
    parts = [pinned, held.read(), held.changes(1)]
    tagged = [rows.select(F.lit(k).alias("version"), "c_custkey", "c_acctbal", "c_mktsegment") for k, rows in enumerate(parts, 1)]
    return tagged[0].unionByName(tagged[1]).unionByName(tagged[2])


@query(UPSERT_SQL)
def feature_table_upsert(spark, folder):
    target, updates = _upsert_input(spark, folder)
    location = scratch_path(spark, "customer_features")
    name = f"patchloom_features.{location.rsplit('/', 1)[-1].replace('-', '_')}"
    spec = FeatureTable(name, ("c_custkey",), buckets=8)
    write_features(target, spec, location)
    return write_features(updates, spec, location)


@query(
    """
    SELECT CASE WHEN o_orderkey % 5 > 0 THEN 0 ELSE o_custkey END AS k, o_orderkey AS t,
           CASE WHEN o_orderkey % 4 = 0 THEN o_totalprice + 100 ELSE o_totalprice END AS price FROM orders
    """
)
def timed_upsert_hot_key(spark, folder):
    """Most rows of a timed table have one key; a quarter of them is replaced."""
    orders = table(spark, folder, "orders", "o_orderkey", "o_custkey", "o_totalprice")
    rows = orders.select(
        F.when(F.col("o_orderkey") % 5 > 0, 0).otherwise(F.col("o_custkey")).alias("k"),
        F.col("o_orderkey").alias("t"),
        F.col("o_totalprice").alias("price"),
    )
    location = scratch_path(spark, "timed_features")
    name = f"patchloom_features.{location.rsplit('/', 1)[-1].replace('-', '_')}"
    spec = FeatureTable(name, ("k",), time_key="t", buckets=8)
    write_features(rows, spec, location)
    changed = rows.filter("t % 4 = 0").withColumn("price", F.col("price") + 100)
    return write_features(changed, spec, location)


@query(
    """
    SELECT o_orderkey, o_totalprice, c_acctbal, c_mktsegment
    FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 7 <> 0) ON o_custkey = c_custkey
    """
)
def feature_lookup_rows(spark, folder):
    orders = table(spark, folder, "orders", "o_orderkey", "o_custkey", "o_totalprice")
    customers = table(spark, folder, "customer").filter("c_custkey % 7 <> 0")
    spec = FeatureLookup("customer", ("c_acctbal", "c_mktsegment"), ("c_custkey",))
    base = orders.withColumnRenamed("o_custkey", "c_custkey")
    return with_features(base, [spec], {"customer": customers}.__getitem__, exclude=["c_custkey", "absent"])


@query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, p_brand, p_retailprice, s_acctbal
    FROM lineitem JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey
    WHERE p_size > 10
    """
)
def several_lookups(spark, folder):
    lines = table(spark, folder, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    sources = {
        "part": table(spark, folder, "part").filter("p_size > 10").withColumnRenamed("p_partkey", "l_partkey"),
        "supplier": table(spark, folder, "supplier").withColumnRenamed("s_suppkey", "l_suppkey"),
    }
    specs = [
        FeatureLookup("part", ("p_brand",), ("l_partkey",), missing="drop"),
        FeatureLookup("supplier", ("s_acctbal",), ("l_suppkey",)),
        FeatureLookup("part", ("p_retailprice",), ("l_partkey",), missing="drop"),
    ]
    return with_features(lines, specs, sources.__getitem__)


@query("SELECT c_acctbal, c_mktsegment FROM customer")
def self_lookup(spark, folder):
    customers = table(spark, folder, "customer", "c_custkey", "c_acctbal", "c_mktsegment")
    spec = FeatureLookup("customer", ("c_acctbal", "c_mktsegment"), ("c_custkey",), missing="error")
    sources = {"customer": customers}
    return with_features(customers, [spec], sources.__getitem__, ["c_custkey"], base_table="customer")


@query("SELECT o_orderkey, o_custkey, c_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_custkey > 5")
def complete_lookup(spark, folder):
    """A lookup that has to find every key, after the absent ones were filled in."""
    orders = table(spark, folder, "orders", "o_orderkey", "o_custkey")
    customers = table(spark, folder, "customer", "c_custkey", "c_name").withColumnRenamed("c_custkey", "o_custkey")
    filled = customers.withColumn("c_name", F.when(F.col("o_custkey") > 5, F.col("c_name")))
    spec = FeatureLookup("customer", ("c_name",), ("o_custkey",), missing="error")
    return with_features(orders, [spec], {"customer": filled}.__getitem__)


# One key for two fifths of all lines, and the null key for another tenth.
HOT_KEY_SQL = "CASE WHEN l_linenumber <= 2 THEN 1 WHEN l_suppkey % 10 > 0 THEN l_suppkey END"


@query(
    f"""
    SELECT k AS s_suppkey, s_name, count(*) AS n_lines, round(sum(l_quantity), 2) AS quantity
    FROM (SELECT {HOT_KEY_SQL} AS k, l_quantity FROM lineitem) LEFT JOIN supplier ON k = s_suppkey
    GROUP BY k, s_name
    """
)
def hot_key_lookup(spark, folder):
    lines = table(spark, folder, "lineitem", "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")
    lines = lines.withColumn("s_suppkey", F.expr(HOT_KEY_SQL))
    suppliers = table(spark, folder, "supplier", "s_suppkey", "s_name")
    joined = lookup_join(lines, suppliers, ["s_suppkey"], "left", salts=16, fraction=20)
    return joined.groupBy("s_suppkey", "s_name").agg(
        F.count(F.lit(1)).alias("n_lines"), F.round(F.sum("l_quantity"), 2).alias("quantity")
    )


@query(
    f"""
    SELECT k AS s_suppkey FROM (SELECT {HOT_KEY_SQL} AS k FROM lineitem)
    GROUP BY k HAVING count(*) * 20 > (SELECT count(*) FROM lineitem)
    """
)
def hot_key_list(spark, folder):
    lines = table(spark, folder, "lineitem", "l_linenumber", "l_suppkey")
    return hot_keys(lines.select(F.expr(HOT_KEY_SQL).alias("s_suppkey")), ["s_suppkey"], fraction=20)


def _as_of_sql(user):
    return f"""
    WITH e AS (SELECT *, {user} AS u FROM events),
    b AS (SELECT event_id, u, ts FROM e WHERE event_type <> 'purchase'),
    f AS (SELECT event_id AS last_event, u, ts AS fts, value AS last_value FROM e WHERE event_type = 'purchase')
    SELECT b.event_id, b.u AS user_id, last_event, last_value FROM b LEFT JOIN f ON f.u = b.u AND f.fts <= b.ts
    QUALIFY row_number() OVER (PARTITION BY b.event_id ORDER BY fts DESC NULLS LAST, last_event DESC) = 1
    """


def _as_of_input(spark, folder, user, key_type="bigint"):
    events = table(spark, folder, "events", "event_id", "ts", "user_id", "event_type", "value")
    events = events.withColumn("user_id", F.expr(user))
    base = events.filter("event_type <> 'purchase'").select("event_id", "user_id", "ts")
    features = events.filter("event_type = 'purchase'").select(
        F.col("user_id").cast(key_type).alias("user_id"), F.col("ts").alias("feature_ts"), F.col("event_id").alias("last_event"), F.col("value").alias("last_value")
    )
    return base, features


def _as_of(spark, folder, user, key_type="bigint", **options):
    base, features = _as_of_input(spark, folder, user, key_type)
    found = point_in_time_lookup(
        base, features, ["user_id"], "ts", "feature_ts", ["last_event", "last_value"], "last_event", **options
    )
    return found.select("event_id", "user_id", "last_event", "last_value")


@query(_as_of_sql("user_id"))
def point_in_time_rows(spark, folder):
    return _as_of(spark, folder, "user_id")


@query(_as_of_sql("CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END"))
def point_in_time_hot_key(spark, folder):
    """One user has a third of all events and is cut into time ranges."""
    return _as_of(spark, folder, "CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END", block_rows=200)


@query(_as_of_sql("CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END"))
def point_in_time_mixed_types(spark, folder):
    """As above, with a narrower key type on the feature side than in the base."""
    return _as_of(spark, folder, "CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END", "int", block_rows=150)


@query(_as_of_sql("event_id % 4 + 10 * (hour(ts) // 6)"))
def point_in_time_many_hot_keys(spark, folder):
    """Every key is hot, and the keys of one quarter of the day have their own times of day."""
    return _as_of(spark, folder, "event_id % 4 + 10 * (hour(ts) div 6)", block_rows=100)


@query(_as_of_sql("user_id").replace("last_event, last_value FROM b", "last_value FROM b"))
def timed_feature_lookup(spark, folder):
    """The same question through a lookup spec: one row per base row, nothing from the future."""
    base, features = _as_of_input(spark, folder, "user_id")
    spec = FeatureLookup(
        "purchases", ("last_value",), ("user_id",), time="feature_ts", base_time="ts", tie_breaker="last_event"
    )
    return with_features(base, [spec], {"purchases": features}.__getitem__, exclude=["ts"])
