"""Catalog, ingest, report and label-scoring queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tracewright.functions.text import is_tag
from tracewright.operators import catalog, labels
from tracewright.plans.log_queries import DOC_CODEC, DOC_SUFFIX, LINES_CTE, event_lines
from tracewright.plans.registry import query, table
from tracewright.session import scratch_path, staged
from tracewright.sources import layout, lines, reports

TAG = "v2026-01-15"

# Each document is a stored log; every fifth is a rolling directory.
ENTRIES_CTE = f"""
WITH entries AS (
  SELECT doc_id, 'run-' || doc_id::VARCHAR AS id,
    CASE WHEN doc_id % 5 = 0 THEN 'logs/run-' || doc_id::VARCHAR || '/eventlog_v2_' || source
         ELSE 'logs/run-' || doc_id::VARCHAR
           || CASE WHEN doc_id % 4 = 0 THEN '.ndjson' ELSE {DOC_SUFFIX} END END AS path,
    'sha256:' || sha256(text) AS checksum, octet_length(encode(text))::BIGINT AS size_bytes,
    CASE WHEN doc_id % 5 = 0 THEN 'rolling-dir' WHEN doc_id % 4 <> 0 THEN 'single-file' END AS log_layout,
    CASE WHEN doc_id % 5 = 0 THEN 'zstd' WHEN doc_id % 4 <> 0 THEN {DOC_CODEC} END AS compression,
    '2026-01-15' AS generated_at, source, lang, n_chars,
    CASE WHEN lang = 'en' THEN 'SKEW,SPEC' WHEN lang = 'fr' THEN 'STRAG' ELSE '' END AS targets
  FROM documents WHERE NOT (doc_id % 5 = 0 AND source = 'src3'))
"""
ENTRY_COLUMNS = (
    "id",
    "path",
    "checksum",
    "size_bytes",
    "log_layout",
    "compression",
    "generated_at",
    "targets",
)


def _doc_id() -> Column:
    return F.concat(F.lit("run-"), F.col("doc_id").cast("string"))


def _doc_targets() -> Column:
    none = F.array().cast("array<string>")
    return (
        F.when(F.col("lang") == "en", F.array(F.lit("SKEW"), F.lit("SPEC")))
        .when(F.col("lang") == "fr", F.array(F.lit("STRAG")))
        .otherwise(none)
    )


def document_entries(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").withColumn("id", _doc_id())
    doc, is_dir = F.col("doc_id"), F.col("doc_id") % 5 == 0
    suffix = F.expr(DOC_SUFFIX)
    runs = documents.select(
        "id",
        F.concat(F.lit("4.2."), (doc % 4).cast("string")).alias("spark_version"),
        F.lit("parquet").alias("table_format"),
        F.col("lang").alias("scenario"),
        F.create_map(F.lit("source"), "source").alias("config"),
        _doc_targets().alias("targets_detectors"),
        F.create_map(F.lit("CSTOR"), "lang").alias("known_misses"),
    )
    name = F.when(is_dir, F.concat(F.lit("eventlog_v2_"), "source")).otherwise(
        F.concat(F.lit("local-"), doc.cast("string"), suffix)
    )
    files = documents.select(
        "id",
        name.alias("name"),
        is_dir.alias("is_dir_log"),
        layout.sha256_tag("text").alias("checksum"),
        F.octet_length("text").cast("long").alias("size_bytes"),
    )
    # A rolling log of source src3 lost its marker, so it is not accepted.
    marker = F.when(F.col("source") == "src3", ".appstatus_app").otherwise("appstatus_app")
    children = F.when(
        is_dir, F.array(F.lit("events_1_app.zstd"), F.lit("events_2_app.zstd"), marker)
    ).otherwise(F.array(name))
    listing = documents.select(
        F.col("id").alias("log_id"),
        F.explode(children).alias("name"),
        F.lit(True).alias("is_file"),
        is_dir.alias("is_dir_log"),
    )
    return catalog.catalog_entries(runs, files, layout.log_layout(listing), F.lit(TAG))


def _shown(entries: DataFrame) -> DataFrame:
    targets = F.array_join("targets_detectors", ",").alias("targets")
    return entries.select(*[targets if c == "targets" else F.col(c) for c in ENTRY_COLUMNS])


@query("catalog_entries", ENTRIES_CTE + f"SELECT {', '.join(ENTRY_COLUMNS)} FROM entries")
def catalog_entries(spark: SparkSession, folder: str) -> DataFrame:
    return _shown(document_entries(spark, folder))


@query("catalog_scan", ENTRIES_CTE + f"SELECT {', '.join(ENTRY_COLUMNS)} FROM entries")
def catalog_scan(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "catalog")
    catalog.save_catalog(document_entries(spark, folder), path)
    return _shown(catalog.load_catalog(spark, path))


@query(
    "catalog_json",
    ENTRIES_CTE
    + """
SELECT doc_id AS ordinal, '{"checksum":"' || checksum || '"'
  || CASE WHEN compression IS NULL THEN '' ELSE ',"compression":"' || compression || '"' END
  || ',"data_repo_tag":"v2026-01-15","id":"' || id || '"'
  || CASE WHEN log_layout IS NULL THEN '' ELSE ',"log_layout":"' || log_layout || '"' END
  || ',"path":"' || path || '","size_bytes":' || size_bytes::VARCHAR || '}' AS entry_json
FROM entries
""",
)
def catalog_json(spark: SparkSession, folder: str) -> DataFrame:
    fields = ["id", "data_repo_tag", "path", "checksum", "size_bytes", "log_layout", "compression"]
    entries = document_entries(spark, folder).select(
        F.substring("id", 5, 20).cast("long").alias("ordinal"), *fields
    )
    return catalog.entry_json(entries, "ordinal")


def labelled_entries(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with a label are the runs the catalog already has."""
    done = table(spark, folder, "labels").select(_doc_id().alias("id"))
    return done.distinct().withColumn("path", F.concat(F.lit("old/"), "id"))


def new_entries(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select(_doc_id().alias("id"))
    return documents.withColumn("path", F.concat(F.lit("new/"), "id"))


KNOWN = "SELECT 'run-' || doc_id::VARCHAR FROM labels"


APPENDED = f"""
SELECT DISTINCT 'run-' || doc_id::VARCHAR AS id, 'old/run-' || doc_id::VARCHAR AS path FROM labels
UNION ALL
SELECT 'run-' || doc_id::VARCHAR, 'new/run-' || doc_id::VARCHAR FROM documents
WHERE 'run-' || doc_id::VARCHAR NOT IN ({KNOWN})
"""


@query("catalog_append", APPENDED)
def catalog_append(spark: SparkSession, folder: str) -> DataFrame:
    return catalog.append_entries(labelled_entries(spark, folder), new_entries(spark, folder))


@query("catalog_saved", APPENDED)
def catalog_saved(spark: SparkSession, folder: str) -> DataFrame:
    """The same through files: saved, loaded, appended to and saved in its place."""
    path = scratch_path(spark, "catalog")
    catalog.save_catalog(labelled_entries(spark, folder), path)
    known = catalog.load_catalog(spark, path)
    catalog.save_catalog(catalog.append_entries(known, new_entries(spark, folder)), path)
    return catalog.load_catalog(spark, path).select("id", "path")


@query(
    "catalog_duplicates",
    f"""
SELECT 'run-' || doc_id::VARCHAR AS id, 'new/run-' || doc_id::VARCHAR AS path FROM documents
WHERE 'run-' || doc_id::VARCHAR IN ({KNOWN})
""",
)
def catalog_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return catalog.duplicates(new_entries(spark, folder), labelled_entries(spark, folder))


@query(
    "resume_pending",
    f"SELECT 'run-' || doc_id::VARCHAR AS id FROM documents "
    f"WHERE 'run-' || doc_id::VARCHAR NOT IN ({KNOWN})",
)
def resume_pending(spark: SparkSession, folder: str) -> DataFrame:
    known = labelled_entries(spark, folder)
    return catalog.pending(new_entries(spark, folder), known).select("id")


# Two upstream folders hold a log per user; users 2n and 2n+1 share a stem.
UPSTREAM = """
CASE WHEN user_id % 2 = 0 THEN 'upstream/alpha/' ELSE 'upstream/alpha-beta/' END || 'u' || {half} || '.log'
"""


@query(
    "external_ingest",
    LINES_CTE
    + f""",
logs AS (SELECT log_id AS user_id, count(*) FILTER (verdict = 'ok') AS good,
  count(*) FILTER (verdict NOT IN ('ok', 'blank')) AS bad FROM verdicts GROUP BY 1),
files AS (SELECT {UPSTREAM.format(half="(user_id // 2)::VARCHAR")} AS path,
  'external-u' || (user_id // 2)::VARCHAR AS id, user_id,
  CASE WHEN bad > 0 THEN 'bad event lines' WHEN good = 0 THEN 'no event lines' END AS reason FROM logs),
known AS (SELECT 'external-u' || c_custkey::VARCHAR AS id FROM customer WHERE c_mktsegment = 'BUILDING'),
winners AS (SELECT id, min(string_split(path, '/')) AS parts FROM files WHERE reason IS NULL GROUP BY 1),
decided AS (SELECT f.*, CASE WHEN f.id IN (SELECT id FROM known) THEN 'known'
  WHEN reason IS NOT NULL THEN 'invalid' WHEN parts <> string_split(path, '/') THEN 'duplicate'
  ELSE 'accepted' END AS status FROM files f LEFT JOIN winners w ON f.id = w.id)
SELECT id, path, status, CASE WHEN status = 'invalid' THEN reason END AS reason,
  'logs/external/' || id || '.ndjson' AS dest,
  'https://example.org/' || CASE WHEN user_id % 2 = 0 THEN 'alpha' ELSE 'alpha-beta' END
    || '/tree/main/events/u' || (user_id // 2)::VARCHAR || '.log' AS source_url
FROM decided
""",
)
def external_ingest(spark: SparkSession, folder: str) -> DataFrame:
    owned = event_lines(spark, folder)
    half = "cast(log_id div 2 as string)"
    path = F.expr(UPSTREAM.format(half=half).replace("user_id", "log_id"))
    validity = staged(lines.validity(owned.withColumn("path", path), "path"), "validity")
    known = table(spark, folder, "customer").where("c_mktsegment = 'BUILDING'")
    known = known.select(F.concat(F.lit("external-u"), "c_custkey").alias("id"))
    name = F.substring_index("path", "/", -1)
    repo = F.concat(
        F.lit("https://example.org/"), F.split("path", "/")[1], F.lit(".git")
    )
    files = validity.select(
        "path",
        name.alias("name"),
        repo.alias("repo"),
        F.lit("main").alias("branch"),
        F.lit("events").alias("subpath"),
    )
    return catalog.external_ingest(files, validity, known)


@query(
    "generation_tag",
    "SELECT 'v' || strftime(arg_min(o_orderdate, o_orderkey), '%Y-%m-%d') AS tag FROM orders",
)
def generation_tag(spark: SparkSession, folder: str) -> DataFrame:
    tag = F.concat(F.lit("v"), F.date_format("o_orderdate", "yyyy-MM-dd"))
    entries = table(spark, folder, "orders").select("o_orderkey", tag.alias("data_repo_tag"))
    return catalog.generation_tag(entries, "o_orderkey")


@query(
    "tag_valid",
    """
WITH tags AS (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders)
SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'v' || day WHEN 1 THEN day
    WHEN 2 THEN 'v' || replace(day, '-', '/') WHEN 3 THEN 'v' || day || '-rc1' ELSE 'v' || day END AS tag,
  o_orderkey % 5 IN (0, 4) AS valid FROM tags
""",
)
def tag_valid(spark: SparkSession, folder: str) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    kind = F.col("o_orderkey") % 5
    tag = (
        F.when(kind == 1, day)
        .when(kind == 2, F.concat(F.lit("v"), F.replace(day, F.lit("-"), F.lit("/"))))
        .when(kind == 3, F.concat(F.lit("v"), day, F.lit("-rc1")))
        .otherwise(F.concat(F.lit("v"), day))
    )
    tags = table(spark, folder, "orders").select("o_orderkey", tag.alias("tag"))
    return tags.withColumn("valid", is_tag("tag"))


# One analyzer report per document, some of them malformed.
REPORT = """
CASE WHEN doc_id % 31 = 0 THEN '{{"findings":[' WHEN doc_id % 37 = 0 THEN '{{"schemaVersion":1}}'
  WHEN doc_id % 41 = 0 THEN '{{"findings":{{"tag":"SKEW"}}}}'
  WHEN doc_id % 43 = 0 THEN '{{"findings":[{{"id":"a","type":"t"}}]}}'
  WHEN doc_id % 47 = 0 THEN '{{"findings":[{{"tag":""}}]}}' WHEN doc_id % 53 = 0 THEN '{{"findings":[{{"tag":7}}]}}'
  WHEN n_chars < 800 THEN '{{"findings":[],"cleanChecks":[{{"tag":"SKEW"}}]}}'
  ELSE '{{"schemaVersion":1,"findings":[{{"id":"1","type":"t","tag":"STRAG"}},{{"tag":"'
    || CASE WHEN lang = 'en' THEN 'SKEW' ELSE 'SPILL' END || '"}},{{"tag":"' || upper(lang)
    || '"}},{{"tag":"STRAG"}}],"cleanChecks":[{{"tag":"SPEC"}}]}}' END
""".format()
REPORT_SQL = """
CASE WHEN doc_id % 31 = 0 THEN 'report is not valid JSON'
  WHEN doc_id % 37 = 0 OR doc_id % 41 = 0 THEN 'report has no findings list'
  WHEN doc_id % 43 = 0 OR doc_id % 47 = 0 OR doc_id % 53 = 0 THEN 'finding without a tag' END
"""
FIRED_SQL = """
CASE WHEN n_chars < 800 THEN []::VARCHAR[]
     ELSE list_sort(['STRAG', CASE WHEN lang = 'en' THEN 'SKEW' ELSE 'SPILL' END, upper(lang)]) END
"""


def analyzer_reports(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(
        _doc_id().alias("id"), "doc_id", F.expr(REPORT).alias("report")
    )


@query(
    "fired_tags",
    f"""
SELECT id, CASE WHEN error IS NULL THEN array_to_string(fired, ',') END AS fired, error
FROM (SELECT 'run-' || doc_id::VARCHAR AS id, {REPORT_SQL} AS error, {FIRED_SQL} AS fired FROM documents)
""",
)
def fired_tags(spark: SparkSession, folder: str) -> DataFrame:
    found = reports.fired_tags(analyzer_reports(spark, folder))
    return found.select("id", F.array_join("fired", ",").alias("fired"), "error")


# Document-derived catalog: targets keep order and repeats, some logs are gone
# or changed, some analyses failed.
LABELS_CTE = f"""
WITH base AS (SELECT *, 'run-' || doc_id::VARCHAR AS id,
    list_filter(['SKEW', CASE WHEN n_chars > 1500 THEN 'SPEC' END, 'STRAG',
      CASE WHEN lang <> 'en' THEN 'SPILL' END, 'SKEW'], lambda x: x IS NOT NULL) AS targets,
    {REPORT_SQL} AS report_error, {FIRED_SQL} AS fires FROM documents),
checked AS (SELECT id, targets, CASE
    WHEN source = 'src7' THEN 'log not found: logs/' || id || '.ndjson'
    WHEN source = 'src8' THEN 'checksum differs from catalog: logs/' || id || '.ndjson'
    WHEN source = 'src9' THEN 'no report'
    WHEN doc_id % 29 = 0 THEN 'analyzer exited 2: cannot parse ' || lang
    ELSE report_error END AS error, fires
  FROM base WHERE source <> 'src1'),
scores AS (SELECT id, targets, error, CASE WHEN error IS NULL THEN fires END AS fired,
    CASE WHEN error IS NULL THEN list_filter(targets, lambda x: NOT list_contains(fires, x)) END AS missing
  FROM checked)
"""


def label_catalog(spark: SparkSession, folder: str) -> DataFrame:
    source = (
        F.when(F.col("source") == "src1", catalog.EXTERNAL).otherwise(catalog.SELF_GENERATED)
    )
    targets = F.array(
        F.lit("SKEW"),
        F.when(F.col("n_chars") > 1500, "SPEC"),
        F.lit("STRAG"),
        F.when(F.col("lang") != "en", "SPILL"),
        F.lit("SKEW"),
    )
    return table(spark, folder, "documents").select(
        _doc_id().alias("id"),
        source.alias("source"),
        F.concat(F.lit("logs/"), _doc_id(), F.lit(".ndjson")).alias("path"),
        layout.sha256_tag("text").alias("checksum"),
        F.array_compact(targets).alias("targets_detectors"),
    )


def label_scores(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    content = F.when(F.col("source") == "src8", F.concat("text", F.lit("!"))).otherwise(
        F.col("text")
    )
    logs = documents.where("source <> 'src7'").select(
        F.concat(F.lit("logs/"), _doc_id(), F.lit(".ndjson")).alias("path"),
        layout.sha256_tag(content).alias("checksum"),
    )
    failed = F.col("doc_id") % 29 == 0
    analyzed = documents.where("source <> 'src9'").select(
        _doc_id().alias("id"),
        F.when(failed, 2).when(F.col("lang") == "fr", 3).otherwise(0).alias("exit_code"),
        F.concat(F.lit("cannot parse "), "lang", F.lit(" ")).alias("message"),
        F.expr(REPORT).alias("report"),
    )
    return labels.label_score(label_catalog(spark, folder), logs, analyzed)


@query(
    "label_score",
    LABELS_CTE
    + """
SELECT id, error, array_to_string(missing, ',') AS missing, array_to_string(fired, ',') AS fired,
  CASE WHEN error IS NOT NULL THEN 'UNCHECKED' WHEN len(missing) > 0 THEN 'MISSED' ELSE 'ok' END AS status
FROM scores
""",
)
def label_score(spark: SparkSession, folder: str) -> DataFrame:
    return label_scores(spark, folder).select(
        "id",
        "error",
        F.array_join("missing", ",").alias("missing"),
        F.array_join("fired", ",").alias("fired"),
        labels.status().alias("status"),
    )


@query(
    "missing_targets",
    LABELS_CTE
    + "SELECT id, array_to_string(missing, ',') AS missing FROM scores WHERE error IS NULL",
)
def missing_targets(spark: SparkSession, folder: str) -> DataFrame:
    checked = label_scores(spark, folder).where(F.col("error").isNull())
    return checked.select("id", F.array_join("missing", ",").alias("missing"))


@query(
    "label_report",
    LABELS_CTE
    + """
SELECT id, CASE WHEN error IS NOT NULL THEN 'UNCHECKED: ' || id || ': ' || error
  WHEN len(missing) > 0 THEN 'MISSED: ' || id || ': ' || array_to_string(missing, ', ')
    || ' did not fire (fired: '
    || CASE WHEN len(fired) > 0 THEN array_to_string(fired, ', ') ELSE 'none' END || ')'
  ELSE 'ok: ' || id END AS line FROM scores
""",
)
def label_report(spark: SparkSession, folder: str) -> DataFrame:
    return labels.label_report(label_scores(spark, folder))


@query(
    "label_totals",
    LABELS_CTE
    + """
SELECT (sum(len(targets)) - sum(len(missing)))::BIGINT AS fired, sum(len(targets))::BIGINT AS targeted
FROM scores WHERE error IS NULL
""",
)
def label_totals(spark: SparkSession, folder: str) -> DataFrame:
    return labels.label_totals(label_scores(spark, folder))


@query(
    "label_verdict",
    LABELS_CTE
    + """
SELECT max(CASE WHEN error IS NOT NULL THEN 2 WHEN len(missing) > 0 THEN 1 ELSE 0 END)::BIGINT AS verdict
FROM scores
""",
)
def label_verdict(spark: SparkSession, folder: str) -> DataFrame:
    return labels.label_verdict(label_scores(spark, folder))


@query(
    "catalog_enrich",
    LABELS_CTE
    + """
SELECT id, coalesce(array_to_string(s.fired, ','), CASE WHEN lang = 'de' THEN 'OLD' END) AS fires_detectors,
  CASE WHEN s.fired IS NOT NULL THEN 'analyzer@1' WHEN lang = 'de' THEN 'analyzer@0' END AS checked_with
FROM base LEFT JOIN scores s USING (id)
""",
)
def catalog_enrich(spark: SparkSession, folder: str) -> DataFrame:
    german = table(spark, folder, "documents").select(
        _doc_id().alias("id"),
        F.when(F.col("lang") == "de", F.array(F.lit("OLD"))).alias("fires_detectors"),
        F.when(F.col("lang") == "de", "analyzer@0").alias("fires_detectors_checked_with"),
    )
    enriched = catalog.enrich(german, label_scores(spark, folder), "analyzer@1")
    return enriched.select(
        "id",
        F.array_join("fires_detectors", ",").alias("fires_detectors"),
        F.col("fires_detectors_checked_with").alias("checked_with"),
    )


# Labelled documents as run definitions with known misses.
MISSES_CTE = """
WITH runs AS (SELECT 'run-' || doc_id::VARCHAR AS id, lang, n_chars, quality, toxic
  FROM documents JOIN labels USING (doc_id)),
targets AS (SELECT id, 'SKEW' AS tag FROM runs WHERE quality = 1
  UNION ALL SELECT id, 'STRAG' FROM runs WHERE lang = 'en'),
misses AS (SELECT id, 'SPEC' AS tag, CASE WHEN toxic = 1 THEN '  ' ELSE 'only in ' || lang END AS reason FROM runs
  UNION ALL SELECT id, 'STRAG', 'long' FROM runs WHERE n_chars > 1500)
"""


def labelled_runs(spark: SparkSession, folder: str) -> DataFrame:
    joined = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id")
    targets = F.array(
        F.when(F.col("quality") == 1, "SKEW"), F.when(F.col("lang") == "en", "STRAG")
    )
    reason = F.when(F.col("toxic") == 1, "  ").otherwise(F.concat(F.lit("only in "), "lang"))
    spec = F.create_map(F.lit("SPEC"), reason)
    both = F.create_map(F.lit("SPEC"), reason, F.lit("STRAG"), F.lit("long"))
    return joined.select(
        _doc_id().alias("id"),
        F.array_compact(targets).alias("targets_detectors"),
        F.when(F.col("n_chars") > 1500, both).otherwise(spec).alias("known_misses"),
    )


@query("known_miss_reasons", MISSES_CTE + "SELECT id, tag, reason FROM misses")
def known_miss_reasons(spark: SparkSession, folder: str) -> DataFrame:
    return labels.known_miss_reasons(labelled_runs(spark, folder))


@query(
    "tag_coverage",
    MISSES_CTE
    + """
SELECT tag, count(*) FILTER (kind = 't') AS as_target, count(*) FILTER (kind = 'm') AS as_known_miss
FROM (SELECT id, tag, 't' AS kind FROM targets UNION ALL SELECT id, tag, 'm' FROM misses) GROUP BY tag
""",
)
def tag_coverage(spark: SparkSession, folder: str) -> DataFrame:
    return labels.tag_coverage(labelled_runs(spark, folder))


@query(
    "known_miss_violations",
    MISSES_CTE
    + """
SELECT id, tag, 'also a target' AS problem FROM misses WHERE (id, tag) IN (SELECT id, tag FROM targets)
UNION ALL SELECT id, tag, 'no reason' FROM misses WHERE trim(reason) = ''
""",
)
def known_miss_violations(spark: SparkSession, folder: str) -> DataFrame:
    return labels.known_miss_violations(labelled_runs(spark, folder))
