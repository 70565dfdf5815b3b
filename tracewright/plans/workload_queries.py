"""Workload and table-mutation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tracewright.operators import dml, rewrite, workload
from tracewright.plans.registry import query, table
from tracewright.session import scratch_path, staged

DRAW = "('0x' || substr(md5({id}::VARCHAR || ':{digest}'), {start}, 8))::BIGINT / 4294967296.0::DOUBLE"


def draw_sql(row_id: str, stream: int) -> str:
    digest, word = divmod(stream, 4)
    return DRAW.format(id=row_id, digest=digest, start=word * 8 + 1)


UNIFORM_KEY = f"floor({draw_sql('o_orderkey', 0)} * 1000)::BIGINT"
SKEWED_KEY = f"CASE WHEN {draw_sql('o_orderkey', 1)} < 0.8 THEN 0 ELSE {UNIFORM_KEY} END"


def order_ids(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(F.col("o_orderkey").alias("row_id"))


@query(
    "gen_fact_uniform",
    f"SELECT {UNIFORM_KEY} AS join_key, count(*) AS n_rows FROM orders GROUP BY 1",
)
def gen_fact_uniform(spark: SparkSession, folder: str) -> DataFrame:
    return workload.key_counts(workload.fact_table(order_ids(spark, folder)))


@query(
    "gen_fact_skewed",
    f"SELECT {SKEWED_KEY} AS join_key, count(*) AS n_rows FROM orders GROUP BY 1",
)
def gen_fact_skewed(spark: SparkSession, folder: str) -> DataFrame:
    return workload.key_counts(workload.fact_table(order_ids(spark, folder), skew="injected"))


@query(
    "gen_payload",
    f"SELECT o_orderkey AS row_id, {UNIFORM_KEY} AS join_key, "
    + ", ".join(f"{draw_sql('o_orderkey', 4 + i)} AS payload_{i}" for i in range(8))
    + " FROM orders",
)
def gen_payload(spark: SparkSession, folder: str) -> DataFrame:
    return workload.fact_table(order_ids(spark, folder), payload_columns=8)


@query(
    "gen_dimension",
    "SELECT p_partkey AS join_key, 'val-0-' || p_partkey::VARCHAR AS attr_0 FROM part",
)
def gen_dimension(spark: SparkSession, folder: str) -> DataFrame:
    keys = table(spark, folder, "part").select(F.col("p_partkey").alias("join_key"))
    return workload.dimension_table(keys, "0")


def key_sum(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"), F.sum("join_key").alias("key_sum"))


@query(
    "stage_roundtrip",
    f"SELECT count(*) AS n_rows, sum({SKEWED_KEY})::BIGINT AS key_sum FROM orders",
)
def stage_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    fact = workload.fact_table(order_ids(spark, folder), skew="injected")
    return key_sum(workload.stage_as_parquet(fact, scratch_path(spark, "fact")))


def supplier_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as fact rows keyed by supplier."""
    return table(spark, folder, "lineitem").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("row_id"),
        F.col("l_suppkey").alias("join_key"),
        F.col("l_extendedprice").alias("payload_0"),
    )


def supplier_dimensions(spark: SparkSession, folder: str) -> list[workload.Dimension]:
    keys = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("join_key"))
    return [
        workload.Dimension(workload.dimension_table(keys, str(i)), "join_key")
        for i in range(workload.DEFAULT_JOIN_TABLES)
    ]


USING_JOIN = """
SELECT l_suppkey AS join_key, l_orderkey * 8 + l_linenumber AS row_id, l_extendedprice AS payload_0,
       'val-0-' || s_suppkey::VARCHAR AS attr_0, 'val-1-' || s_suppkey::VARCHAR AS attr_1
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
"""


@query("star_join_using", USING_JOIN)
def star_join_using(spark: SparkSession, folder: str) -> DataFrame:
    return workload.workload_join(
        supplier_facts(spark, folder), supplier_dimensions(spark, folder), ["row_id"]
    )


@query("star_join_using_merge", USING_JOIN)
def star_join_using_merge(spark: SparkSession, folder: str) -> DataFrame:
    return workload.shuffled_star_join(
        supplier_facts(spark, folder), supplier_dimensions(spark, folder), ["row_id"]
    )


@query("star_join_bucketed", USING_JOIN)
def star_join_bucketed(spark: SparkSession, folder: str) -> DataFrame:
    """The chain over tables staged in buckets of their key: no exchange in the join."""
    path = scratch_path(spark, "bucketed")
    fact, dimensions = workload.stage_star(
        supplier_facts(spark, folder),
        supplier_dimensions(spark, folder),
        ["row_id"],
        f"star_{path[-32:]}",
        path,
        buckets=8,
        salts=2,
    )
    return workload.bucketed_star_join(fact, dimensions)


@query(
    "write_parquet_roundtrip",
    "SELECT count(*) AS n_rows, sum(l_suppkey)::BIGINT AS key_sum "
    "FROM lineitem JOIN supplier ON l_suppkey = s_suppkey",
)
def write_parquet_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    written = workload.run_workload(
        supplier_facts(spark, folder),
        supplier_dimensions(spark, folder),
        scratch_path(spark, "joined"),
    )
    return key_sum(written)


@query(
    "write_staged_fact",
    "SELECT count(*) AS n_rows, sum(l_suppkey)::BIGINT AS key_sum "
    "FROM lineitem JOIN supplier ON l_suppkey = s_suppkey",
)
def write_staged_fact(spark: SparkSession, folder: str) -> DataFrame:
    """The run whose fact comes from files: staged as Parquet, joined from there."""
    path = scratch_path(spark, "run")
    written = workload.run_workload(
        supplier_facts(spark, folder),
        supplier_dimensions(spark, folder),
        f"{path}/joined",
        staging_path=f"{path}/fact",
    )
    return key_sum(written)


STAR_JOIN = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, s_name, p_name, l_extendedprice
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
"""


def line_star(spark: SparkSession, folder: str) -> tuple[DataFrame, list[workload.Dimension]]:
    fact = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"
    )
    supplier = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), "s_name"
    )
    part = table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    return fact, [
        workload.Dimension(supplier, "l_suppkey"),
        workload.Dimension(part, "l_partkey"),
    ]


@query("star_join_chain", STAR_JOIN)
def star_join_chain(spark: SparkSession, folder: str) -> DataFrame:
    fact, dimensions = line_star(spark, folder)
    return workload.workload_join(fact, dimensions, ["l_orderkey", "l_linenumber"])


@query("star_join_merge_hint", STAR_JOIN)
def star_join_merge_hint(spark: SparkSession, folder: str) -> DataFrame:
    fact, dimensions = line_star(spark, folder)
    return workload.shuffled_star_join(fact, dimensions, ["l_orderkey", "l_linenumber"])


@query("key_counts", "SELECT l_suppkey AS join_key, count(*) AS n_rows FROM lineitem GROUP BY 1")
def key_counts(spark: SparkSession, folder: str) -> DataFrame:
    return workload.key_counts(table(spark, folder, "lineitem"), "l_suppkey")


@query("row_count", "SELECT count(*) AS n_rows FROM lineitem")
def row_count(spark: SparkSession, folder: str) -> DataFrame:
    return workload.row_count(table(spark, folder, "lineitem"))


@query(
    "count_where",
    "SELECT count(*) AS n_rows FROM orders WHERE o_orderstatus = 'F' AND "
    "(o_orderkey % 4 = 0 OR o_orderkey % 4 = 1)",
)
def count_where(spark: SparkSession, folder: str) -> DataFrame:
    return workload.row_count(
        table(spark, folder, "orders"),
        "o_orderstatus = 'F' AND (o_orderkey % 4 = 0 OR o_orderkey % 4 = 1)",
    )


@query(
    "cached_reuse",
    "SELECT l_suppkey AS join_key, count(*) AS n_rows FROM lineitem GROUP BY 1",
)
def cached_reuse(spark: SparkSession, folder: str) -> DataFrame:
    return workload.run_workload(
        supplier_facts(spark, folder),
        supplier_dimensions(spark, folder),
        scratch_path(spark, "cached"),
        persist_mode="memory-and-disk",
        second_action="reread",
    )


SEED_VALUE = draw_sql("o_orderkey", 0)
ORDERS_N = "(SELECT count(*) FROM orders)"
MERGE_IDS = f"""
SELECT o_orderkey AS id FROM orders WHERE o_orderkey % 5 = 0
UNION ALL
SELECT o_orderkey + {ORDERS_N} FROM orders WHERE o_orderkey < {ORDERS_N} // 10
"""


def target_ids(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(F.col("o_orderkey").alias("id"))


def source_ids(ids: DataFrame, n: int) -> DataFrame:
    """The target's ids and ``n // 10`` new ones past them."""
    shifted = ids.where(F.col("id") < n // dml.INSERT_FRACTION).select(F.col("id") + n)
    return ids.union(shifted)


def merge_source_of(spark: SparkSession, folder: str) -> DataFrame:
    ids = target_ids(spark, folder)
    n = ids.count()
    return dml.merge_source_rows(source_ids(ids, n), n)


@query(
    "seed_target",
    f"SELECT o_orderkey AS id, o_orderkey % 4 AS bucket, {SEED_VALUE} AS value, "
    "'seed' AS status FROM orders",
)
def seed_target(spark: SparkSession, folder: str) -> DataFrame:
    return dml.seed_rows(target_ids(spark, folder))


@query(
    "partitioned_write_counts",
    "SELECT o_orderkey % 4 AS bucket, count(*) AS n_rows FROM orders GROUP BY 1",
)
def partitioned_write_counts(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "seeded")
    ids = target_ids(spark, folder)
    dml.seed_table(ids, path)
    seeded = spark.read.schema(dml.seed_rows(ids).schema).parquet(path)
    return seeded.groupBy("bucket").agg(F.count("*").alias("n_rows"))


@query(
    "merge_source",
    f"SELECT id, id % 4 AS bucket, {draw_sql('id', 0)} + 1000 AS value, 'merged' AS status "
    f"FROM ({MERGE_IDS})",
)
def merge_source(spark: SparkSession, folder: str) -> DataFrame:
    return merge_source_of(spark, folder)


def merged_sql(buckets: str) -> str:
    return f"""
WITH source AS (
  SELECT id, id % 4 AS bucket, {draw_sql('id', 0)} + 1000 AS value FROM ({MERGE_IDS})
  WHERE id % 4 IN ({buckets})),
target AS (SELECT o_orderkey AS id, o_orderkey % 4 AS bucket, {SEED_VALUE} AS value FROM orders)
SELECT coalesce(s.id, t.id) AS id, coalesce(s.bucket, t.bucket) AS bucket,
       coalesce(s.value, t.value) AS value,
       CASE WHEN s.id IS NULL THEN 'seed' ELSE 'merged' END AS status
FROM target t FULL OUTER JOIN source s ON t.id = s.id
"""


def target_of(spark: SparkSession, folder: str) -> DataFrame:
    return dml.seed_rows(target_ids(spark, folder))


@query("merge_upsert", merged_sql("0, 1, 2, 3"))
def merge_upsert(spark: SparkSession, folder: str) -> DataFrame:
    return dml.merge(target_of(spark, folder), merge_source_of(spark, folder), "id")


@query("merge_upsert_api", merged_sql("0, 1, 2, 3"))
def merge_upsert_api(spark: SparkSession, folder: str) -> DataFrame:
    return (
        dml.merge_into(target_of(spark, folder), merge_source_of(spark, folder), "id")
        .when_matched_update_all()
        .when_not_matched_insert_all()
        .execute()
    )


@query("merge_bucket", merged_sql("0, 1"))
def merge_bucket(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "concurrent")
    source = merge_source_of(spark, folder)
    dml.seed_table(target_ids(spark, folder), path)
    dml.merge_partitions(spark, path, source, "id", "bucket", dml.CONCURRENT_BUCKETS)
    return spark.read.schema(source.schema).parquet(path)


@query("merge_concurrent", merged_sql("0, 1"))
def merge_concurrent(spark: SparkSession, folder: str) -> DataFrame:
    """Two merges into one table at once, each into its own partition."""
    path = scratch_path(spark, "at-once")
    source = merge_source_of(spark, folder)
    dml.seed_table(target_ids(spark, folder), path)
    dml.merge_buckets_at_once(spark, path, source, "id", "bucket", dml.CONCURRENT_BUCKETS)
    return spark.read.schema(source.schema).parquet(path)


# One file per part of 500 ids; statements touch some parts' files only.
PART_IDS = 500


def parted(rows: DataFrame) -> DataFrame:
    return rows.withColumn("part", F.expr(f"id div {PART_IDS}"))


def seed_parts(spark: SparkSession, folder: str, path: str) -> DataFrame:
    """The seeded target as one file a part, and the files it has."""
    seeded = parted(target_of(spark, folder))
    seeded.repartition("part").write.partitionBy("part").options(**rewrite.COMMIT_IN_TASKS).parquet(path)
    return staged(file_names(spark, path, seeded), "files-before")


def file_names(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    return spark.read.schema(like.schema).parquet(path).select("part", F.col("_metadata.file_name").alias("file")).distinct()


def file_account(spark: SparkSession, path: str, before: DataFrame, schema) -> DataFrame:
    """Per part: rows, rows changed, and how many of its files are the old ones."""
    now = spark.read.schema(schema).parquet(path)
    rows = now.groupBy("part").agg(
        F.count("*").alias("n_rows"), F.count_if(F.col("status") != "seed").alias("n_changed")
    )
    kept = file_names(spark, path, now).join(before, ["part", "file"]).groupBy("part").agg(F.count("*").alias("n_kept"))
    return rows.join(kept, "part", "left").select(
        "part", "n_rows", "n_changed", F.coalesce("n_kept", F.lit(0)).cast("long").alias("n_kept")
    )


@query(
    "merge_files",
    f"""
WITH source AS (
  SELECT o_orderkey AS id FROM orders WHERE o_orderkey % 5 = 0 AND o_orderkey % 7000 < 900
  UNION ALL SELECT o_orderkey + {ORDERS_N} FROM orders WHERE o_orderkey < {ORDERS_N} // 10),
merged AS (SELECT coalesce(s.id, o_orderkey) // {PART_IDS} AS part, s.id IS NOT NULL AS changed,
    s.id IS NOT NULL AND o_orderkey IS NOT NULL AS matched, o_orderkey IS NOT NULL AS old
  FROM orders FULL OUTER JOIN source s ON s.id = o_orderkey)
SELECT part, count(*) AS n_rows, count(*) FILTER (changed) AS n_changed,
  CASE WHEN bool_or(old) AND NOT bool_or(matched) THEN 1 ELSE 0 END::BIGINT AS n_kept FROM merged GROUP BY part
""",
)
def merge_files(spark: SparkSession, folder: str) -> DataFrame:
    """A merge that touches few files of a table and leaves the others in place."""
    path = scratch_path(spark, "parts")
    before = seed_parts(spark, folder, path)
    n = target_ids(spark, folder).count()
    source = parted(merge_source_of(spark, folder)).where(f"id >= {n} OR id % 7000 < 900")
    rewrite.merge_files(spark, path, source, ["id", "part"], ["part"])
    return file_account(spark, path, before, source.schema)


@query(
    "rewrite_files",
    f"""
WITH updated AS (SELECT o_orderkey AS id, o_orderkey // {PART_IDS} AS part, o_orderkey % 2500 < 10 AS changed FROM orders),
parts AS (SELECT part, bool_or(changed) OR bool_or(id % 3000 < 300) AS touched FROM updated GROUP BY part)
SELECT part, count(*) AS n_rows, count(*) FILTER (changed) AS n_changed,
  CASE WHEN bool_or(touched) THEN 0 ELSE 1 END::BIGINT AS n_kept
FROM updated JOIN parts USING (part) WHERE id % 3000 >= 300 GROUP BY part
""",
)
def rewrite_files(spark: SparkSession, folder: str) -> DataFrame:
    """An update and a delete that each rewrite the files with matching rows only."""
    path = scratch_path(spark, "parts")
    before = seed_parts(spark, folder, path)
    schema = parted(target_of(spark, folder)).schema
    rewrite.update_files(spark, path, schema, "id % 2500 < 10", ASSIGN, ["part"])
    rewrite.delete_files(spark, path, schema, "id % 3000 < 300", ["part"])
    return file_account(spark, path, before, schema)


@query("merge_pinned", merged_sql("0, 1"))
def merge_pinned(spark: SparkSession, folder: str) -> DataFrame:
    return dml.merge(
        target_of(spark, folder),
        merge_source_of(spark, folder),
        "id",
        pin={"bucket": dml.CONCURRENT_BUCKETS},
    )


ASSIGN = {"value": f"value * {dml.UPDATE_FACTOR}", "status": "'updated'"}


@query(
    "update_where",
    f"""SELECT o_orderkey AS id, o_orderkey % 4 AS bucket,
       CASE WHEN o_orderkey % 10 = 0 THEN {SEED_VALUE} * 1.1::DOUBLE ELSE {SEED_VALUE} END AS value,
       CASE WHEN o_orderkey % 10 = 0 THEN 'updated' ELSE 'seed' END AS status FROM orders""",
)
def update_where(spark: SparkSession, folder: str) -> DataFrame:
    return dml.update_where(target_of(spark, folder), f"id % {dml.UPDATE_EVERY} = 0", ASSIGN)


@query(
    "delete_where",
    f"""SELECT o_orderkey AS id, o_orderkey % 4 AS bucket, {SEED_VALUE} AS value,
       'seed' AS status FROM orders WHERE NOT o_orderkey % 4 = 0""",
)
def delete_where(spark: SparkSession, folder: str) -> DataFrame:
    return dml.delete_where(target_of(spark, folder), f"id % {dml.DELETE_EVERY} = 0")


@query(
    "dml_postconditions",
    f"""
WITH n AS (SELECT count(*) AS n FROM orders),
ids AS ({MERGE_IDS}),
merged AS (SELECT s.id IS NOT NULL AS merged, coalesce(s.id, o_orderkey) AS id
  FROM orders FULL OUTER JOIN ids s ON s.id = o_orderkey),
updated AS (SELECT CASE WHEN o_orderkey % 10 = 0 THEN 'updated' ELSE 'seed' END AS status FROM orders),
checks AS (
  SELECT 'merge total' AS check_name, n + n // 10 AS expected, (SELECT count(*) FROM merged) AS actual FROM n
  UNION ALL SELECT 'merge merged', (n + 4) // 5 + n // 10, (SELECT count(*) FILTER (merged) FROM merged) FROM n
  UNION ALL SELECT 'update total', n, (SELECT count(*) FROM updated) FROM n
  UNION ALL SELECT 'update updated', (n + 9) // 10, (SELECT count(*) FILTER (status = 'updated') FROM updated) FROM n
  UNION ALL SELECT 'delete total', n - (n + 3) // 4,
         (SELECT count(*) FROM orders WHERE o_orderkey % 4 <> 0) FROM n
  UNION ALL SELECT 'concurrent merged',
         (n + 19) // 20 + (n + 14) // 20 + (n + n // 10 + 3) // 4 - (n + 3) // 4 + (n + n // 10 + 2) // 4 - (n + 2) // 4,
         (SELECT count(*) FILTER (merged AND id % 4 IN (0, 1)) FROM merged) FROM n)
SELECT check_name, expected::BIGINT AS expected, actual::BIGINT AS actual,
       expected = actual AS ok FROM checks
""",
)
def dml_postconditions(spark: SparkSession, folder: str) -> DataFrame:
    """Each statement's result written once, its rows counted by the write itself."""
    target, source = target_of(spark, folder), merge_source_of(spark, folder)
    merged = dml.merge(target, source, "id")
    pinned = dml.merge(target, source, "id", pin={"bucket": dml.CONCURRENT_BUCKETS})
    wanted = [
        (merged, {"merge total": "true", "merge merged": "status = 'merged'"}),
        (update_where(spark, folder), {"update total": "true", "update updated": "status = 'updated'"}),
        (delete_where(spark, folder), {"delete total": "true"}),
        (pinned, {"concurrent merged": "status = 'merged' AND (bucket = 0 OR bucket = 1)"}),
    ]
    actual = [dml.observed_write(df, scratch_path(spark, "counted"), checks) for df, checks in wanted]
    return dml.check_counts(actual, dml.expected_counts(target))
