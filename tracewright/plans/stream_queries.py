"""Queries over logs that arrive in drops."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tracewright.functions.text import base_name
from tracewright.plans.encoding import write_logs
from tracewright.plans.log_queries import LINES_CTE, event_lines
from tracewright.plans.registry import query
from tracewright.session import scratch_path
from tracewright.streaming import ingest

TAG = "v2026-01-15"
ORIGIN = ingest.Origin("https://example.org/alpha.git", "main", "events", "MIT")
# Even users' logs arrive first, then odd ones'; every tenth user's log arrives again
# under its name in another folder.
ARRIVED = f"""{LINES_CTE},
logs AS (
  SELECT log_id, 'user-' || log_id::VARCHAR AS stem, count(*) FILTER (verdict = 'ok') AS good,
    count(*) FILTER (verdict NOT IN ('ok', 'blank')) AS bad,
    string_agg(value || chr(10), '' ORDER BY event_id) AS content FROM verdicts GROUP BY log_id),
files AS (
  SELECT stem, good, bad, content, log_id % 2 AS batch FROM logs
  UNION ALL SELECT stem, good, bad, content, 2 FROM logs WHERE log_id % 10 = 0)
"""


@query(
    "stream_ingest",
    ARRIVED
    + """
SELECT 'external-' || stem AS id, 'accepted' AS status, batch, 'logs/external/external-' || stem || '.ndjson' AS path,
  'sha256:' || sha256(content) AS checksum, octet_length(encode(content))::BIGINT AS size_bytes,
  'https://example.org/alpha/tree/main/events/' || stem || '.ndjson' AS source_url, '2026-01-15' AS fetched_at
FROM files WHERE bad = 0 AND good > 0 AND batch < 2
UNION ALL
SELECT stem, CASE WHEN bad > 0 THEN 'bad event lines' ELSE 'no event lines' END, batch, NULL, NULL, NULL, NULL, NULL
FROM files WHERE bad > 0 OR good = 0
""",
)
def stream_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Three drops of files, the stream started anew for each from its checkpoint."""
    root = scratch_path(spark, "arrivals")
    folders = ingest.Corpus(f"{root}/corpus")
    logs = event_lines(spark, folder)
    name = F.concat(F.lit("user-"), F.col("log_id").cast("string"), F.lit(".ndjson"))
    drops = [logs.where("log_id % 2 = 0"), logs.where("log_id % 2 = 1"), logs.where("log_id % 10 = 0")]
    for number, drop in enumerate(drops):
        write_logs(drop.withColumn("name", name), f"{root}/inbox/drop-{number}", "event_id")
        files = ingest.arriving(spark, f"{root}/inbox/*")
        ingest.ingest_arrivals(files, folders, ORIGIN, F.lit(TAG)).awaitTermination()
    entries = ingest.entries(spark, folders).select(
        "id", F.lit("accepted").alias("status"), "batch", "path", "checksum", "size_bytes", "source_url", "fetched_at"
    )
    refused = ingest.refused(spark, folders).select(
        F.regexp_replace(base_name("id"), r"\.ndjson$", "").alias("id"), F.col("reason").alias("status"), "batch"
    )
    return entries.unionByName(refused, allowMissingColumns=True)
