"""Event-log line, layout, digest and decoding queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tracewright.functions.text import codec_of
from tracewright.operators import corpus
from tracewright.plans.encoding import write_encoded
from tracewright.plans.registry import query, table
from tracewright.session import scratch_path
from tracewright.sources import decode, layout, lines, logsource
from tracewright.sources.files import list_logs

# Every third user's log has damaged lines of several kinds; all have blanks.
EVENT_JSON = """'{{"Event":"' || event_type || '","event_id":' || event_id{text} || ',"props":' || props || '}}'"""
LINE = """
CASE WHEN event_id % 83 = 0 THEN '   '
     WHEN user_id % 3 <> 0 THEN {json}
     WHEN event_id % 89 = 0 THEN substr({json}, 1, 20)
     WHEN event_id % 97 = 0 THEN '{{"event_id":' || event_id{text} || '}}'
     WHEN event_id % 101 = 0 THEN {json} || ' trailing'
     WHEN event_id % 103 = 0 THEN '["Event"]'
     WHEN event_id % 107 = 0 THEN '{{"x":{{"Event":1}}}}'
     WHEN event_id % 109 = 0 THEN '{{"Event":null}}'
     WHEN event_id % 113 = 0 THEN {json} || {json}
     ELSE '  ' || {json} END
"""


def line_sql(text_cast: str) -> str:
    return LINE.format(json=EVENT_JSON.format(text=text_cast), text=text_cast)


LINES_CTE = f"""
WITH lines AS (SELECT user_id AS log_id, event_id, event_type, {line_sql('::VARCHAR')} AS value FROM events),
verdicts AS (
  SELECT log_id, event_id, event_type, value,
         CASE WHEN trim(value) = '' THEN 'blank'
              WHEN NOT json_valid(trim(value)) THEN 'not_json'
              WHEN json_type(trim(value)) <> 'OBJECT' THEN 'missing_event'
              WHEN NOT list_contains(json_keys(trim(value)), 'Event') THEN 'missing_event'
              ELSE 'ok' END AS verdict
  FROM lines)
"""


def event_lines(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        F.col("user_id").alias("log_id"), "event_id", F.expr(line_sql("")).alias("value")
    )


@query(
    "ndjson_event_count",
    LINES_CTE
    + """
SELECT log_id, count(*) FILTER (verdict = 'ok') AS n_events,
       count(*) FILTER (verdict = 'blank') AS n_blank,
       count(*) FILTER (verdict NOT IN ('ok', 'blank')) AS n_bad,
       n_bad = 0 AND n_events > 0 AS valid
FROM verdicts GROUP BY log_id
""",
)
def ndjson_event_count(spark: SparkSession, folder: str) -> DataFrame:
    return lines.count_events(event_lines(spark, folder))


@query(
    "ndjson_bad_lines",
    LINES_CTE
    + "SELECT log_id, event_id, verdict AS reason FROM verdicts WHERE verdict NOT IN ('ok', 'blank')",
)
def ndjson_bad_lines(spark: SparkSession, folder: str) -> DataFrame:
    return lines.bad_lines(event_lines(spark, folder))


@query(
    "event_type_counts",
    LINES_CTE
    + """
SELECT json_extract_string(trim(value), '$.Event') AS event_type, count(*) AS n_events
FROM verdicts WHERE verdict = 'ok' GROUP BY 1
""",
)
def event_type_counts(spark: SparkSession, folder: str) -> DataFrame:
    return lines.event_type_counts(event_lines(spark, folder))


@query(
    "ndjson_file_scan",
    LINES_CTE
    + """
SELECT count(*) FILTER (verdict = 'ok') AS n_events, count(*) FILTER (verdict = 'blank') AS n_blank,
       count(*) FILTER (verdict NOT IN ('ok', 'blank')) AS n_bad FROM verdicts
""",
)
def ndjson_file_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Lines written to text files, scanned back and validated per file."""
    path = scratch_path(spark, "ndjson")
    event_lines(spark, folder).select("value").write.text(path)
    per_file = lines.count_events(lines.read_lines(spark, path), "path")
    return per_file.agg(*[F.sum(c).alias(c) for c in ("n_events", "n_blank", "n_bad")])


@query(
    "bad_line_numbers",
    LINES_CTE
    + """
SELECT event_id, verdict AS reason FROM verdicts WHERE verdict NOT IN ('ok', 'blank')
""",
)
def bad_line_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """Bad lines located by file and line number, mapped back to the event
    that was written on that line."""
    path = scratch_path(spark, "numbered")
    # A line naming the event goes before each event's line, so the line
    # before a bad one tells which event it came from.
    pairs = F.array(F.concat(F.lit('{"Event":"row-'), "event_id", F.lit('"}')), "value")
    event_lines(spark, folder).select(F.explode(pairs).alias("value")).write.text(path)
    scanned = lines.read_lines(spark, path)
    found = lines.numbered(lines.bad_lines(scanned), scanned)
    named = lines.numbered(scanned.where(F.col("value").startswith('{"Event":"row-')), scanned)
    owner = named.select(
        "path",
        (F.col("line_no") + 1).alias("line_no"),
        F.regexp_extract("value", "row-([0-9]+)", 1).cast("long").alias("event_id"),
    )
    return found.join(owner, ["path", "line_no"]).select("event_id", "reason")


PATH_SQL = """
'logs/' || page_id{text} || CASE page_id % 8 WHEN 0 THEN '.zstd' WHEN 1 THEN '.lz4' WHEN 2 THEN '.snappy'
  WHEN 3 THEN '' WHEN 4 THEN '.gz' WHEN 5 THEN '/.zstd' WHEN 6 THEN '.b.zstd' ELSE '.zstd.crc' END
"""


@query(
    "codec_of_path",
    f"""
SELECT path, CASE WHEN path LIKE '%/.zstd' THEN 'none' WHEN path LIKE '%.zstd' THEN 'zstd'
  WHEN path LIKE '%.lz4' THEN 'lz4' WHEN path LIKE '%.snappy' THEN 'snappy' ELSE 'none' END AS codec
FROM (SELECT {PATH_SQL.format(text='::VARCHAR')} AS path FROM pages)
""",
)
def codec_of_path(spark: SparkSession, folder: str) -> DataFrame:
    paths = table(spark, folder, "pages").select(F.expr(PATH_SQL.format(text="")).alias("path"))
    return paths.select("path", codec_of("path").alias("codec"))


# One rolling directory per user with a file per day of activity. Some lack a
# marker or an index, mix codecs, repeat an index or have no event files.
ROLLED = """
WITH days AS (SELECT user_id, CAST(ts AS DATE) AS day, sum(length(props)) AS length FROM events GROUP BY 1, 2),
ranked AS (SELECT user_id, length, row_number() OVER (PARTITION BY user_id ORDER BY day) AS rank FROM days),
indexed AS (SELECT user_id, length, rank,
  CASE WHEN user_id % 7 = 0 AND rank >= 3 THEN rank + 1 WHEN user_id % 17 = 0 AND rank = 2 THEN 1
       ELSE rank END AS idx FROM ranked),
named AS (SELECT user_id, length, CASE WHEN user_id % 23 = 0 THEN 'other_' ELSE 'events_' END
  || CAST(idx AS {text}) || '_app' || CAST(user_id AS {text})
  || CASE WHEN user_id % 13 = 0 AND rank = 2 THEN '.zstd'
          ELSE CASE user_id % 4 WHEN 0 THEN '' WHEN 1 THEN '.zstd' WHEN 2 THEN '.lz4' ELSE '.snappy' END
     END AS name FROM indexed),
users AS (SELECT DISTINCT user_id FROM events),
files AS (
  SELECT user_id AS log_id, name, TRUE AS is_file, CAST(length AS BIGINT) AS length FROM named
  UNION ALL
  SELECT user_id, CASE WHEN user_id % 11 = 0 THEN '.appstatus_app' ELSE 'appstatus_app' END, TRUE,
         CAST(0 AS BIGINT) FROM users
  UNION ALL
  SELECT user_id, 'events_99_folder', FALSE, CAST(0 AS BIGINT) FROM users)
"""
ROLLED_SQL = ROLLED.format(text="VARCHAR")
CHECK_CTE = (
    ROLLED_SQL
    + """,
matched AS (SELECT log_id, name, is_file AND regexp_full_match(name, 'events_[0-9]+_.+') AS hit,
  CASE WHEN hit THEN regexp_extract(name, 'events_([0-9]+)_.+', 1)::BIGINT END AS idx,
  CASE WHEN NOT hit THEN NULL WHEN name LIKE '%.zstd' THEN 'zstd' WHEN name LIKE '%.lz4' THEN 'lz4'
       WHEN name LIKE '%.snappy' THEN 'snappy' ELSE 'none' END AS codec FROM files),
checked AS (SELECT log_id, count(idx) AS n_files, min(idx) AS min_idx, max(idx) AS max_idx,
  n_files > 0 AND coalesce(list_sort(list(idx) FILTER (idx IS NOT NULL)) = range(1, n_files + 1), false) AS contiguous,
  bool_or(name LIKE 'appstatus\\_%' ESCAPE '\\') AS has_marker,
  list_sort(list(DISTINCT codec) FILTER (codec IS NOT NULL)) AS codecs FROM matched GROUP BY log_id),
judged AS (SELECT *, CASE WHEN n_files = 0 THEN 'no event files'
  WHEN NOT contiguous THEN 'event file indexes are not 1..' || n_files::VARCHAR
  WHEN NOT has_marker THEN 'no marker file' END AS error FROM checked)
"""
)


def rolled_files(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("user_id", "ts", "props")
    days = events.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.sum(F.length("props")).alias("length")
    )
    # A user has at most one row per calendar day here.
    rank = F.row_number().over(Window.partitionBy("user_id").orderBy("day"))
    u = F.col("user_id")
    indexed = days.withColumn("rank", rank).withColumn(
        "idx",
        F.when((u % 7 == 0) & (F.col("rank") >= 3), F.col("rank") + 1)
        .when((u % 17 == 0) & (F.col("rank") == 2), 1)
        .otherwise(F.col("rank")),
    )
    suffix = F.when((u % 13 == 0) & (F.col("rank") == 2), ".zstd").otherwise(_suffix(u))
    prefix = F.when(u % 23 == 0, "other_").otherwise("events_")
    name = F.concat(prefix, F.col("idx").cast("string"), F.lit("_app"), u.cast("string"), suffix)
    event_rows = indexed.select(
        u.alias("log_id"), name.alias("name"), F.lit(True).alias("is_file"), "length"
    )
    marker = F.when(u % 11 == 0, ".appstatus_app").otherwise("appstatus_app")
    extras = F.array(
        F.struct(marker.alias("name"), F.lit(True).alias("is_file")),
        F.struct(F.lit("events_99_folder").alias("name"), F.lit(False).alias("is_file")),
    )
    extra_rows = (
        events.select("user_id")
        .distinct()
        .select(u.alias("log_id"), F.explode(extras).alias("x"))
        .select("log_id", "x.name", "x.is_file", F.lit(0).cast("long").alias("length"))
    )
    return event_rows.unionByName(extra_rows)


def _suffix(number: Column) -> Column:
    return (
        F.when(number % 4 == 0, "")
        .when(number % 4 == 1, ".zstd")
        .when(number % 4 == 2, ".lz4")
        .otherwise(".snappy")
    )


@query(
    "rolling_dir_check",
    CHECK_CTE
    + """SELECT log_id, n_files, min_idx, max_idx, contiguous, has_marker,
       array_to_string(codecs, ',') AS codecs, error FROM judged""",
)
def rolling_dir_check(spark: SparkSession, folder: str) -> DataFrame:
    checked = layout.rolling_dir_check(rolled_files(spark, folder))
    codecs = F.when(F.size("codecs") > 0, F.array_join("codecs", ","))
    return checked.withColumn("codecs", codecs)


@query(
    "rolling_file_order",
    CHECK_CTE
    + """SELECT log_id, idx, name FROM matched
    WHERE hit AND log_id IN (SELECT log_id FROM judged WHERE error IS NULL)""",
)
def rolling_file_order(spark: SparkSession, folder: str) -> DataFrame:
    return layout.rolling_file_order(rolled_files(spark, folder))


DOC_SUFFIX = "CASE doc_id % 4 WHEN 0 THEN '' WHEN 1 THEN '.zstd' WHEN 2 THEN '.lz4' ELSE '.snappy' END"
DOC_CODEC = "CASE doc_id % 4 WHEN 0 THEN 'none' WHEN 1 THEN 'zstd' WHEN 2 THEN 'lz4' ELSE 'snappy' END"


@query(
    "log_layout",
    CHECK_CTE
    + f"""
SELECT 'u' || log_id::VARCHAR AS log_id, 'rolling-dir' AS layout,
       CASE WHEN len(codecs) = 1 THEN codecs[1] END AS compression,
       coalesce(error, CASE WHEN len(codecs) > 1 THEN 'event files mix codecs '
         || array_to_string(codecs, ', ') END) AS error FROM judged
UNION ALL
SELECT 'd' || doc_id::VARCHAR, 'single-file', {DOC_CODEC}, NULL FROM documents
""",
)
def log_layout(spark: SparkSession, folder: str) -> DataFrame:
    directories = rolled_files(spark, folder).select(
        F.concat(F.lit("u"), F.col("log_id").cast("string")).alias("log_id"),
        "name",
        "is_file",
        F.lit(True).alias("is_dir_log"),
    )
    doc = F.col("doc_id")
    singles = table(spark, folder, "documents").select(
        F.concat(F.lit("d"), doc.cast("string")).alias("log_id"),
        F.concat(F.lit("local-"), doc.cast("string"), _suffix(doc)).alias("name"),
        F.lit(True).alias("is_file"),
        F.lit(False).alias("is_dir_log"),
    )
    return layout.log_layout(directories.unionByName(singles))


@query(
    "log_size",
    ROLLED_SQL
    + "SELECT log_id, sum(length)::BIGINT AS size_bytes FROM files WHERE is_file GROUP BY 1",
)
def log_size(spark: SparkSession, folder: str) -> DataFrame:
    return layout.log_size(rolled_files(spark, folder))


# A directory holds fifty consecutive pages under their URL paths.
PAGE_PATH = "regexp_extract(url, '//[^/]+/(.*)$', 1) || '-' || page_id{text}"


@query(
    "dir_checksum",
    f"""
WITH files AS (SELECT 'pages-' || (page_id // 50)::VARCHAR AS log_id,
  {PAGE_PATH.format(text='::VARCHAR')} AS path, sha256(html) AS digest FROM pages)
SELECT log_id, 'sha256:' || sha256(string_agg(path || chr(0) || digest || chr(10), ''
  ORDER BY string_split(path, '/'))) AS checksum FROM files GROUP BY 1
""",
)
def dir_checksum(spark: SparkSession, folder: str) -> DataFrame:
    files = table(spark, folder, "pages").select(
        F.expr("'pages-' || page_id div 50").alias("log_id"),
        F.expr(PAGE_PATH.format(text="")).alias("path"),
        F.sha2("html", 256).alias("digest"),
    )
    return layout.dir_checksum(files)


@query(
    "log_relpath",
    f"""
SELECT 'run-' || doc_id::VARCHAR AS log_id,
  CASE WHEN doc_id % 5 = 0 THEN 'logs/run-' || doc_id::VARCHAR || '/eventlog_v2_' || source
       ELSE 'logs/run-' || doc_id::VARCHAR || CASE WHEN doc_id % 4 = 0 THEN '.ndjson' ELSE {DOC_SUFFIX} END
  END AS relpath FROM documents
""",
)
def log_relpath(spark: SparkSession, folder: str) -> DataFrame:
    doc = F.col("doc_id")
    named = table(spark, folder, "documents").select(
        F.concat(F.lit("run-"), doc.cast("string")).alias("log_id"),
        (doc % 5 == 0).alias("is_dir"),
        F.when(doc % 5 == 0, F.concat(F.lit("eventlog_v2_"), "source"))
        .otherwise(F.concat(F.lit("local-"), doc.cast("string"), _suffix(doc)))
        .alias("name"),
    )
    return named.select("log_id", layout.log_relpath("log_id", "is_dir", "name").alias("relpath"))


@query(
    "decode_logs",
    LINES_CTE + "SELECT value, count(*) AS n_lines FROM lines GROUP BY 1",
)
def decode_logs(spark: SparkSession, folder: str) -> DataFrame:
    """Lines written in all four encodings, decoded in small chunks."""
    files = write_encoded(event_lines(spark, folder), "event_id", scratch_path(spark, "encoded"))
    decoded = decode.decode_logs(files, chunk_bytes=64 << 10)
    return decoded.groupBy("value").agg(F.count("*").alias("n_lines"))


@query(
    "read_logs",
    LINES_CTE + "SELECT value, count(*) AS n_lines FROM lines GROUP BY 1",
)
def read_logs(spark: SparkSession, folder: str) -> DataFrame:
    """The same through the data source, files cut into partitions."""
    path = scratch_path(spark, "encoded")
    write_encoded(event_lines(spark, folder), "event_id", path)
    found = logsource.read_logs(spark, f"{path}/logs", chunk_bytes=64 << 10)
    return found.where("error IS NULL").groupBy("value").agg(F.count("*").alias("n_lines"))


@query(
    "validate_logs",
    LINES_CTE
    + """
SELECT layout, n_events FROM (SELECT 'single-file' AS layout, count(*) AS n_events
FROM verdicts WHERE verdict = 'ok')
""",
)
def validate_logs(spark: SparkSession, folder: str) -> DataFrame:
    """Encoded logs listed from their folder and validated, events in total."""
    path = scratch_path(spark, "encoded")
    write_encoded(event_lines(spark, folder), "event_id", path)
    checked = corpus.validate_logs(list_logs(spark, [f"{path}/logs"]))
    return checked.groupBy("layout").agg(F.sum("n_events").alias("n_events"))


@query(
    "decode_event_counts",
    LINES_CTE
    + """
SELECT count(*) FILTER (verdict = 'ok') AS n_events, count(*) FILTER (verdict = 'blank') AS n_blank,
       count(*) FILTER (verdict NOT IN ('ok', 'blank')) AS n_bad FROM verdicts
""",
)
def decode_event_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Encoded logs validated file by file, totals over all files."""
    files = write_encoded(event_lines(spark, folder), "event_id", scratch_path(spark, "encoded"))
    decoded = decode.decode_logs(files)
    per_file = lines.count_events(decoded, "path")
    return per_file.agg(*[F.sum(c).alias(c) for c in ("n_events", "n_blank", "n_bad")])
