"""One query per operator over the given tables, and SQL for its result where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patchloom.llm.common import text_of

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def read(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    frame = spark.read.parquet(f"{folder}/{name}.parquet")
    return frame.select(*columns) if columns else frame


@query(
    """
    WITH hashed AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents),
    grouped AS (
        SELECT text_sha256, max(doc_id) AS keep_id, count(*)::BIGINT AS group_size FROM hashed GROUP BY text_sha256
    )
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM hashed JOIN grouped USING (text_sha256)
    """
)
def op4_exact_dedup(spark, folder):
    from patchloom.llm.exact_dedup import content_groups

    docs = read(spark, folder, "documents", "doc_id", "text")
    hashed = docs.withColumn("text_sha256", F.sha2(text_of("text"), 256))
    return content_groups(hashed, carry=("text_sha256",))


@query(
    """
    WITH rows AS (
        SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
               ('0x' || substr(md5(doc_id::VARCHAR), 1, 13))::BIGINT AS place
        FROM documents
    ),
    sizes AS (
        SELECT source, sum(size)::BIGINT AS source_size,
               (ARRAY[5.0, 2.0, 1.0]::DOUBLE[])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w
        FROM rows GROUP BY source
    ),
    levels AS (
        SELECT *, (sum(source_size) OVER () - coalesce(sum(source_size) OVER before, 0) * 3)::DOUBLE
                  / (sum(w) OVER () - coalesce(sum(w) OVER before, 0)) AS level
        FROM sizes
        WINDOW before AS (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    ),
    flagged AS (SELECT *, level * w <= source_size * 3 AS below_cap FROM levels),
    targets AS (
        SELECT source, source_size,
               CASE WHEN below_cap THEN (arg_min(level, source_size / w) FILTER (WHERE below_cap) OVER ()) * w
                    ELSE (source_size * 3)::DOUBLE END AS target
        FROM flagged
    ),
    budgets AS (
        SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 3)::BIGINT ELSE 0 END AS whole,
               target - (CASE WHEN source_size > 0 THEN least(floor(target / source_size), 3)::BIGINT ELSE 0 END)
               * source_size AS budget
        FROM targets
    ),
    running AS (
        SELECT r.*, b.source_size, b.target, b.whole, b.budget,
               sum(r.size) OVER (PARTITION BY r.source ORDER BY r.place RANGE UNBOUNDED PRECEDING) AS upto,
               max(r.place) OVER (PARTITION BY r.source) AS last
        FROM rows r JOIN budgets b ON r.source IS NOT DISTINCT FROM b.source
    ),
    edges AS (
        SELECT source, min(place) AS edge FROM running WHERE upto > budget OR place = last GROUP BY source
    ),
    spans AS (
        SELECT e.source, e.edge, min(r.upto) AS upto, min(r.upto) - sum(r.size) AS below, min(r.budget) AS budget
        FROM edges e JOIN running r ON r.source IS NOT DISTINCT FROM e.source AND r.place = e.edge
        GROUP BY e.source, e.edge
    )
    SELECT r.doc_id, r.size, r.source_size, r.target,
           (r.size * least(r.whole + CASE
               WHEN r.place < s.edge OR (r.place = s.edge AND abs(s.upto - s.budget) < s.budget - s.below) THEN 1
               ELSE 0 END, 3))::BIGINT AS taken
    FROM running r JOIN spans s ON r.source IS NOT DISTINCT FROM s.source
    """
)
def op3_mixing(spark, folder):
    from patchloom.llm.mixing import mix

    docs = read(spark, folder, "documents", "doc_id", "text", "source")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


@query()
def op2_secrets(spark, folder):
    from patchloom.llm import secrets

    docs = read(spark, folder, "documents", "doc_id", "text")
    ratios = secrets.fit(secrets.labelled_samples(docs, "doc_id", "text"))
    found = secrets.scan(docs, ratios)
    base = F.filter("spans", lambda s: s["kind"] < secrets.KINDS.index("markov"))
    return found.select(
        "doc_id",
        *[secrets.count_of(F.col("spans"), kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(secrets.listed(base), 256).alias("base_sha256"),
        secrets.listed(F.col("spans")).alias("spans"),
    )


@query()
def op8_minhash(spark, folder):
    from patchloom.llm.minhash import MinMax, near_duplicates

    return near_duplicates(read(spark, folder, "documents", "doc_id", "text"), MinMax(words=4))


@query()
def op6_token_files(spark, folder):
    from patchloom.llm.token_files import read_tokens, write_tokens
    from patchloom.session import scratch_path

    path = scratch_path(spark, "token-store")
    write_tokens(read(spark, folder, "documents", "doc_id", "text"), path)
    return read_tokens(spark, path, summary=True).withColumnRenamed("id", "doc_id")


@query()
def op10_packing(spark, folder):
    from patchloom.llm.packing import pack_documents

    return pack_documents(read(spark, folder, "documents", "doc_id", "text"))


@query()
def op7_quality(spark, folder):
    from patchloom.llm import quality
    from patchloom.llm.language import fold_of, learnable

    docs = read(spark, folder, "documents", "doc_id", "text")
    labels = learnable(read(spark, folder, "labels", "doc_id", "quality"), folds=5, held=0)
    scored = quality.score(docs, quality.train(docs, labels))
    return scored.select(
        "doc_id",
        (fold_of("doc_id", 5) == 0).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
    )


@query()
def op9_language(spark, folder):
    from patchloom.llm.language import fold_of, identify, learnable, train

    docs = read(spark, folder, "documents", "doc_id", "text", "lang")
    found = identify(docs, train(learnable(docs)))
    return found.select("doc_id", (fold_of("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score", "ambiguous")


@query()
def op1_substring_dedup(spark, folder):
    from patchloom.llm.substring_dedup import repeated_passages

    return repeated_passages(read(spark, folder, "documents", "doc_id", "text"))


@query()
def op5_neighbours(spark, folder):
    from patchloom.llm.neighbours import nearest

    return nearest(read(spark, folder, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 20 == 0)


@query()
def op11_sharding(spark, folder):
    from patchloom.llm.sharding import read_shards, row_size, write_shards
    from patchloom.session import scratch_path

    docs = read(spark, folder, "documents", "doc_id", "text")
    path = scratch_path(spark, "shards")
    write_shards(docs, path)
    found = read_shards(spark, path, docs.schema).withColumn("text", F.col("row.text"))
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        row_size("text").alias("size"),
        F.crc32(text_of("text").cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query()
def op12_whitening(spark, folder):
    from patchloom.llm.whitening import whitened

    return whitened(read(spark, folder, "embeddings", "vec_id", "embedding"))


TRIE_SQL = """
    WITH ranked AS (
        SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos,
               md5(coalesce(role, '') || chr(31) || coalesce(text, '')) AS said, length(coalesce(text, '')) AS chars
        FROM conversations
    ),
    convs AS (
        SELECT DISTINCT conv_id, conv_id - conv_id % 100 AS base,
               xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ord(s)::BIGINT)),
                   lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 6 AS h
        FROM conversations
    ),
    turns AS (
        SELECT c.conv_id, 0 AS part, r.pos, r.said, r.chars FROM convs c JOIN ranked r ON r.conv_id = c.base AND r.pos <= c.h
        UNION ALL SELECT c.conv_id, 1, r.pos, r.said, r.chars FROM convs c JOIN ranked r ON r.conv_id = c.conv_id AND r.pos > c.h
    ),
    rebuilt AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS depth, said, chars FROM turns),
    ways AS (
        SELECT conv_id, 0 AS depth, '' AS node, NULL AS parent, 0 AS chars FROM convs
        UNION ALL
        SELECT conv_id, depth, node, coalesce(lag(node) OVER (PARTITION BY conv_id ORDER BY depth), ''), chars FROM (
            SELECT conv_id, depth, chars, md5(array_to_string(list(said) OVER (PARTITION BY conv_id ORDER BY depth), ' ')) AS node FROM rebuilt)
    ),
    nodes AS (
        SELECT node, depth, any_value(parent) AS parent, any_value(chars) AS chars, min(conv_id) AS conv_id, count(*) AS n_convs
        FROM ways GROUP BY node, depth
    ),
    kids AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY parent),
    full_nodes AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM nodes n LEFT JOIN kids k USING (node)),
    below AS (
        SELECT w.node, sum(CASE WHEN n.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n.n_convs - 1) * n.chars) AS saved_tokens
        FROM full_nodes n JOIN ways w ON w.conv_id = n.conv_id AND w.depth <= n.depth GROUP BY w.node
    ),
    lengths AS (SELECT conv_id, max(depth) AS depth FROM ways GROUP BY conv_id),
    ends AS (SELECT node, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM ways JOIN lengths USING (conv_id, depth) GROUP BY node)
    SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, b.n_leaves::BIGINT AS n_leaves,
           b.saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
    FROM full_nodes n JOIN below b USING (node) LEFT JOIN nodes p ON p.node = n.parent AND n.depth > 0 LEFT JOIN ends e ON e.node = n.node
"""


@query(TRIE_SQL)
def op13_prefix_trie(spark, folder):
    from patchloom.llm.common import store
    from patchloom.llm.prefix_trie import ordered_turns, prefix_trie, with_openings

    given = store(ordered_turns(read(spark, folder, "conversations")), "turns")
    turns, conversations = with_openings(given)
    return prefix_trie(store(turns, "rebuilt-turns"), conversations)


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES["pipeline"] = pipeline
