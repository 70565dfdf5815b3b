"""Version, run-matrix, configuration and partition queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tracewright.functions.text import minor_line, version_parts, version_text
from tracewright.operators import catalog, confs, partitions, runs, versions
from tracewright.plans.registry import query, table
from tracewright.session import scratch_path
from tracewright.sources import reports

# Each part is a release; the newest per line is that line's pin.
TRIPLES = """
WITH triples AS (SELECT p_partkey, (3 + p_partkey % 2)::BIGINT AS major,
  ((p_partkey // 2) % 5)::BIGINT AS minor, (p_size % 20)::BIGINT AS patch FROM part),
pins AS (SELECT major::VARCHAR || '.' || minor::VARCHAR AS line,
  major::VARCHAR || '.' || minor::VARCHAR || '.' || max(patch)::VARCHAR AS version
  FROM triples GROUP BY major, minor)
"""


def part_versions(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        "p_partkey",
        (F.col("p_partkey") % 2 + 3).cast("int").alias("major"),
        F.expr("cast((p_partkey div 2) % 5 as int)").alias("minor"),
        (F.col("p_size") % 20).alias("patch"),
    )


def pins(spark: SparkSession, folder: str) -> DataFrame:
    newest = part_versions(spark, folder).groupBy("major", "minor").agg(
        F.max("patch").alias("patch")
    )
    version = version_text("major", "minor", "patch")
    return newest.select(minor_line(version).alias("line"), version.alias("version"))


@query(
    "latest_patch_per_line",
    TRIPLES + "SELECT major, minor, max(patch) AS patch FROM triples GROUP BY 1, 2",
)
def latest_patch_per_line(spark: SparkSession, folder: str) -> DataFrame:
    texts = part_versions(spark, folder).select(version_text("major", "minor", "patch").alias("v"))
    parsed = texts.select(version_parts("v").alias("p")).select("p.*")
    return versions.latest_patch_per_line(parsed)


@query(
    "minor_line",
    TRIPLES
    + """
SELECT p_partkey, major::VARCHAR || '.' || minor::VARCHAR || '.' || patch::VARCHAR AS version,
  major::VARCHAR || '.' || minor::VARCHAR AS line FROM triples
""",
)
def minor_line_query(spark: SparkSession, folder: str) -> DataFrame:
    rows = part_versions(spark, folder).select(
        "p_partkey", version_text("major", "minor", "patch").alias("version")
    )
    return rows.withColumn("line", minor_line("version"))


@query(
    "version_drift",
    TRIPLES
    + """,
pinned AS (SELECT (3 + s_nationkey % 3)::VARCHAR || '.' || (s_nationkey % 7)::VARCHAR AS line,
  (3 + s_nationkey % 3)::VARCHAR || '.' || (s_nationkey % 7)::VARCHAR || '.'
    || max(s_suppkey % 23)::VARCHAR AS pinned FROM supplier GROUP BY s_nationkey % 3, s_nationkey % 7),
listed AS (SELECT DISTINCT major::VARCHAR || '.' || minor::VARCHAR || '.' || patch::VARCHAR AS v FROM triples)
SELECT line, 'newer' AS kind, pinned, version AS upstream FROM pinned JOIN pins USING (line) WHERE pinned <> version
UNION ALL SELECT line, 'not listed', pinned, NULL FROM pinned WHERE pinned NOT IN (SELECT v FROM listed)
UNION ALL SELECT line, 'not pinned', NULL, version FROM pins WHERE line NOT IN (SELECT line FROM pinned)
""",
)
def version_drift(spark: SparkSession, folder: str) -> DataFrame:
    nation = F.col("s_nationkey")
    pinned = (
        table(spark, folder, "supplier")
        .groupBy((nation % 3 + 3).alias("major"), (nation % 7).alias("minor"))
        .agg(F.max(F.col("s_suppkey") % 23).alias("patch"))
    )
    version = version_text("major", "minor", "patch")
    pinned = pinned.select(minor_line(version).alias("line"), version.alias("pinned"))
    return versions.version_drift(pinned, part_versions(spark, folder))


@query(
    "extract_from_html",
    """
SELECT page_id, pos::BIGINT AS pos, href FROM (
  SELECT page_id, unnest(found) AS href, generate_subscripts(found, 1) AS pos
  FROM (SELECT page_id, regexp_extract_all(html, 'href="([^"]+)"', 1) AS found FROM pages))
""",
)
def extract_from_html(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "html")
    return reports.extract_all(pages, "html", 'href="([^"]+)"', "href")


@query(
    "versions_from_listing",
    TRIPLES + "SELECT p_partkey, 1::BIGINT AS pos, major, minor, patch FROM triples",
)
def versions_from_listing(spark: SparkSession, folder: str) -> DataFrame:
    """Releases read back from listing rows among anchors of other kinds."""
    version = version_text("major", "minor", "patch")
    html = F.concat(
        F.lit('<a href="../">..</a> <a href="spark-docs/">docs</a> <a href="spark-'),
        version,
        F.lit('/">spark-'),
        version,
        F.lit("/</a>"),
    )
    listing = part_versions(spark, folder).select("p_partkey", html.alias("html"))
    found = reports.listed_versions(listing, strict=True)
    return found.select("p_partkey", "pos", "major", "minor", "patch")


FORMATS_SQL = "unnest(['parquet', 'delta', 'iceberg']) AS table_format"


@query(
    "baseline_matrix",
    TRIPLES
    + f"""
SELECT 'spark-' || line || '-' || table_format || '-baseline' AS id, version AS spark_version, table_format
FROM (SELECT line, version, {FORMATS_SQL} FROM pins)
""",
)
def baseline_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return runs.baseline_runs(pins(spark, folder)).select("id", "spark_version", "table_format")


SCENARIOS_SQL = """
(VALUES ('pairwise-01', 'pairwise', 0, 'SPEC,HOST,STRAG,SKEW,CACHE'),
  ('pairwise-02', 'pairwise', 1, 'PART,TINY,UTIL,COLD,CACHE'),
  ('pairwise-03', 'pairwise', 2, 'PART,TINY,UTIL,COLD,HOST'),
  ('pairwise-04', 'pairwise', 3, 'SHFL,SPILL,UTIL,COLD,STRAG,CACHE'),
  ('pairwise-05', 'pairwise', 4, 'SHFL,SPILL,UTIL,COLD,SKEW'),
  ('pairwise-06', 'pairwise', 5, 'SHFL,SPILL,PART,TINY,HOST,STRAG,SKEW'),
  ('pairwise-07', 'pairwise', 6, 'SHFL,SPILL,PART,TINY,CACHE'),
  ('failure-task-retry', 'failure', 0, 'RETRY'), ('failure-stage-abort', 'failure', 1, 'FAIL,SFAIL'),
  ('failure-job', 'failure', 2, 'JOBS'), ('failure-killed-run', 'failure', 3, 'INCMP'),
  ('cache-memory-only', 'cache', 0, 'CSTOR'), ('cache-memory-and-disk', 'cache', 1, 'CSTOR'),
  ('eventlog-spark4-default', 'event-log', 0, ''), ('eventlog-rolling', 'event-log', 1, ''),
  ('eventlog-zstd', 'event-log', 2, ''), ('eventlog-lz4', 'event-log', 3, ''),
  ('eventlog-snappy', 'event-log', 4, ''), ('delta-merge-sql', 'dml', 0, ''),
  ('delta-merge-api', 'dml', 1, ''), ('delta-update', 'dml', 2, ''), ('delta-delete', 'dml', 3, ''),
  ('delta-concurrent-merge', 'dml', 4, '')) AS scenarios (id, family, position, targets)
"""
ALL_RUNS_CTE = (
    TRIPLES
    + f""",
all_runs AS (
  SELECT 'spark-' || line || '-' || table_format || '-baseline' AS id, 'baseline' AS family,
    (list_position(['parquet', 'delta', 'iceberg'], table_format) - 1)::INTEGER AS position,
    version AS spark_version, table_format, '' AS targets
  FROM (SELECT line, version, {FORMATS_SQL} FROM pins)
  UNION ALL
  SELECT id, family, position, (SELECT version FROM pins WHERE line = '4.2'),
    CASE WHEN family = 'dml' THEN 'delta' ELSE 'parquet' END, targets FROM {SCENARIOS_SQL})
"""
)


@query(
    "all_runs",
    ALL_RUNS_CTE
    + """
SELECT id, family, (list_position(['baseline', 'pairwise', 'failure', 'cache', 'event-log', 'dml'], family) - 1)::INTEGER
  AS family_ordinal, position, spark_version, table_format, targets FROM all_runs
""",
)
def all_runs(spark: SparkSession, folder: str) -> DataFrame:
    return runs.all_runs(pins(spark, folder)).select(
        "id",
        "family",
        "family_ordinal",
        "position",
        "spark_version",
        "table_format",
        F.array_join("targets_detectors", ",").alias("targets"),
    )


@query(
    "matrix_counts",
    ALL_RUNS_CTE + "SELECT family, count(*) AS n_runs FROM all_runs GROUP BY 1",
)
def matrix_counts(spark: SparkSession, folder: str) -> DataFrame:
    return runs.matrix_counts(runs.all_runs(pins(spark, folder)))


@query(
    "artifact_lookup",
    TRIPLES
    + f""",
known AS (SELECT * FROM (VALUES ('3.5', 'delta', 'io.delta:delta-spark_2.12:3.2.0'),
  ('3.5', 'iceberg', 'org.apache.iceberg:iceberg-spark-runtime-3.5_2.12:1.6.1'),
  ('4.0', 'delta', 'io.delta:delta-spark_4.0_2.13:4.4.0'),
  ('4.0', 'iceberg', 'org.apache.iceberg:iceberg-spark-runtime-4.0_2.13:1.11.0'),
  ('4.1', 'delta', 'io.delta:delta-spark_4.1_2.13:4.4.0'),
  ('4.1', 'iceberg', 'org.apache.iceberg:iceberg-spark-runtime-4.1_2.13:1.11.0'),
  ('4.2', 'delta', 'io.delta:delta-spark_4.2_2.13:4.4.0')) AS k (line, table_format, a)),
wanted AS (SELECT line, {FORMATS_SQL} FROM pins)
SELECT line, table_format, CASE WHEN table_format = 'parquet' THEN '' ELSE a END AS artifact,
  table_format <> 'parquet' AND a IS NULL AS skipped
FROM wanted LEFT JOIN known USING (line, table_format)
""",
)
def artifact_lookup(spark: SparkSession, folder: str) -> DataFrame:
    found = runs.artifacts_of_runs(runs.baseline_runs(pins(spark, folder)))
    return found.select("line", "table_format", "artifact", "skipped")


@query(
    "family_overlap",
    """
SELECT 'run-' || o_custkey::VARCHAR AS id FROM orders GROUP BY o_custkey
HAVING count(DISTINCT o_orderpriority) > 1
""",
)
def family_overlap(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as run ids, order priorities as the families they occur in."""
    rows = table(spark, folder, "orders").select(
        F.concat(F.lit("run-"), F.col("o_custkey").cast("string")).alias("id"),
        F.col("o_orderpriority").alias("family"),
    )
    return runs.family_overlap(rows)


# Four axes of each order; some value pairs never occur together.
AXES_SQL = """
SELECT o_orderkey AS id, CASE WHEN o_totalprice > 250000 THEN 'true' ELSE 'false' END AS aqe,
  CASE WHEN o_orderkey % 3 = 0 THEN '2000' ELSE '200' END AS shuffle_partitions,
  CASE WHEN o_orderstatus = 'F' THEN 'injected' ELSE 'none' END AS skew,
  CASE WHEN o_orderstatus = 'F' THEN 'memory-only' ELSE 'none' END AS caching FROM orders
"""
AXIS_VALUES = {
    "aqe": ["true", "false"],
    "shuffle_partitions": ["200", "2000"],
    "skew": ["none", "injected"],
    "caching": ["none", "memory-only"],
}


def _pairs_sql() -> str:
    names = list(AXIS_VALUES)
    parts = []
    for i, a in enumerate(names):
        for b in names[i + 1 :]:
            for x in AXIS_VALUES[a]:
                for y in AXIS_VALUES[b]:
                    parts.append(
                        f"SELECT '{a}' AS axis_a, '{x}' AS value_a, '{b}' AS axis_b, '{y}' AS value_b, "
                        f"count(*) FILTER ({a} = '{x}' AND {b} = '{y}') AS n_runs FROM axes"
                    )
    return f"WITH axes AS ({AXES_SQL}) " + " UNION ALL ".join(parts)


@query("pairwise_coverage", _pairs_sql())
def pairwise_coverage(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    rows = orders.selectExpr(
        "o_orderkey AS id",
        "CASE WHEN o_totalprice > 250000 THEN 'true' ELSE 'false' END AS aqe",
        "CASE WHEN o_orderkey % 3 = 0 THEN '2000' ELSE '200' END AS shuffle_partitions",
        "CASE WHEN o_orderstatus = 'F' THEN 'injected' ELSE 'none' END AS skew",
        "CASE WHEN o_orderstatus = 'F' THEN 'memory-only' ELSE 'none' END AS caching",
    )
    return runs.pairwise_coverage(rows, AXIS_VALUES)


# Conf layers of each order: a base, one that may be absent, and its own.
SHUFFLE, AQE, MEMORY = (
    "spark.sql.shuffle.partitions",
    "spark.sql.adaptive.enabled",
    "spark.memory.fraction",
)


def order_confs(spark: SparkSession, folder: str) -> DataFrame:
    base = F.create_map(F.lit(SHUFFLE), F.lit("200"), F.lit(AQE), F.lit("true"))
    pressure = F.create_map(F.lit(MEMORY), F.lit("0.02"), F.lit(SHUFFLE), F.lit("2000"))
    own = F.create_map(F.lit(AQE), F.lit("false"), F.lit("spark.app.name"), "o_orderpriority")
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        base.alias("base"),
        F.when(F.col("o_orderstatus") == "F", pressure).alias("pressure"),
        F.when(F.col("o_orderstatus") != "P", own).alias("own"),
    )


def merged_confs(spark: SparkSession, folder: str) -> DataFrame:
    layers = confs.merge_confs(F.col("base"), F.col("pressure"), F.col("own"))
    return order_confs(spark, folder).select("id", "base", layers.alias("conf"))


@query(
    "conf_merge",
    f"""
SELECT o_orderkey AS id, '{SHUFFLE}' AS key, CASE WHEN o_orderstatus = 'F' THEN '2000' ELSE '200' END AS value FROM orders
UNION ALL SELECT o_orderkey, '{AQE}', CASE WHEN o_orderstatus = 'P' THEN 'true' ELSE 'false' END FROM orders
UNION ALL SELECT o_orderkey, '{MEMORY}', '0.02' FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey, 'spark.app.name', o_orderpriority FROM orders WHERE o_orderstatus <> 'P'
""",
)
def conf_merge(spark: SparkSession, folder: str) -> DataFrame:
    return confs.exploded(merged_confs(spark, folder), F.col("conf"))


@query(
    "conf_defaults",
    f"""
SELECT o_orderkey AS id, '{MEMORY}' AS key, CASE WHEN o_orderstatus = 'F' THEN '0.02' ELSE '0.6' END AS value FROM orders
UNION ALL SELECT o_orderkey, 'spark.app.name', CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority ELSE 'unnamed' END FROM orders
UNION ALL SELECT o_orderkey, 'spark.speculation', 'false' FROM orders
""",
)
def conf_defaults(spark: SparkSession, folder: str) -> DataFrame:
    defaults = {MEMORY: "0.6", "spark.app.name": "unnamed", "spark.speculation": "false"}
    return confs.exploded(merged_confs(spark, folder), confs.with_defaults("conf", defaults))


@query(
    "config_diff",
    f"""
SELECT o_orderkey AS id, '{SHUFFLE}' AS key, '2000' AS value FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey, '{AQE}', 'false' FROM orders WHERE o_orderstatus <> 'P'
UNION ALL SELECT o_orderkey, '{MEMORY}', '0.02' FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey, 'spark.app.name', o_orderpriority FROM orders WHERE o_orderstatus <> 'P'
""",
)
def config_diff(spark: SparkSession, folder: str) -> DataFrame:
    diff = confs.conf_diff(F.col("conf"), F.col("base"))
    return confs.exploded(merged_confs(spark, folder), diff)


TYPED = """
WITH runs AS (SELECT o_orderkey AS id, o_orderkey % 3 <> 0 AS aqe, CASE WHEN o_orderkey % 2 = 0 THEN 200 ELSE 2000 END AS parts,
  o_orderkey % 5 = 0 AS pressed, o_orderstatus AS status FROM orders)
"""


@query(
    "config_diff_typed",
    TYPED
    + f"""
SELECT id, 'aqe' AS path, 'false' AS value FROM runs WHERE NOT aqe
UNION ALL SELECT id, 'shuffle_partitions', '2000' FROM runs WHERE parts = 2000
UNION ALL SELECT id, 'status', '"' || status || '"' FROM runs
UNION ALL SELECT id, 'spark_confs/{SHUFFLE}', '"' || parts::VARCHAR || '"' FROM runs
UNION ALL SELECT id, 'spark_confs/{MEMORY}', '"0.02"' FROM runs WHERE pressed
""",
)
def config_diff_typed(spark: SparkSession, folder: str) -> DataFrame:
    """Nested, typed configs saved in a catalog, loaded and compared with a baseline:
    a setting differs by type too, and Spark's settings stay text."""
    order = F.col("o_orderkey")
    parts = F.when(order % 2 == 0, "200").otherwise("2000")
    pressed = F.when(order % 5 == 0, F.create_map(F.lit(MEMORY), F.lit("0.02"))).otherwise(
        F.create_map().cast("map<string,string>")
    )
    settings = F.create_map(
        F.lit("aqe"), (order % 3 != 0).cast("string"), F.lit("shuffle_partitions"), parts, F.lit("status"), "o_orderstatus"
    )
    runs_ = table(spark, folder, "orders").select(
        order.cast("string").alias("id"),
        runs.typed_config(settings, spark_confs=F.map_concat(F.create_map(F.lit(SHUFFLE), parts), pressed)).alias(
            "config_diff"
        ),
    )
    path = scratch_path(spark, "catalog")
    catalog.save_catalog(runs_, path)
    base = F.parse_json(F.lit('{"aqe": true, "shuffle_partitions": 200, "skew": "none", "spark_confs": {}}'))
    loaded = catalog.load_catalog(spark, path).select("id", "config_diff", base.alias("base"))
    diff = confs.typed_diff(loaded, "config_diff", "base")
    return diff.select(F.col("id").cast("long").alias("id"), F.array_join("path", "/").alias("path"), "value")


PROFILED = 12


@query(
    "partition_profile",
    f"""
SELECT count(*) AS n_rows, {PROFILED}::BIGINT AS n_partitions, {PROFILED - 1}::BIGINT AS last_partition
FROM lineitem
""",
)
def partition_profile(spark: SparkSession, folder: str) -> DataFrame:
    """What holds of every profile: all rows are seen once, and the partitions
    are numbered from 0 without a gap."""
    keys = table(spark, folder, "lineitem").select("l_orderkey").repartition(PROFILED, "l_orderkey")
    return partitions.partition_profile(keys).agg(
        F.sum("n_rows").alias("n_rows"),
        F.count_distinct("partition_id").alias("n_partitions"),
        F.max("partition_id").alias("last_partition"),
    )
