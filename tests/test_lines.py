import json
import random

import pytest
from pyspark.sql import functions as F

from tracewright.functions.jsonlines import with_verdict
from tracewright.sources import lines

CASES = [
    ('{"Event":"SparkListenerApplicationStart"}', "ok"),
    ('  {"Event":"a","x":[1,2]}\t', "ok"),
    ('　{"Event":"a"} ', "ok"),
    ('{"Event":null}', "ok"),
    ('{"Event":{"nested":1}}', "ok"),
    ("", "blank"),
    (" \t  ", "blank"),
    ("not json", "not_json"),
    ('{"Event":"a"} x', "not_json"),
    ('{"Event":"a"}{"Event":"b"}', "not_json"),
    ('{"Event":"a"},0] [', "not_json"),
    ('{"Event":"a"}] [2', "not_json"),
    ('{"Event":"a"', "not_json"),
    ("{'Event':'a'}", "not_json"),
    ('{"Event":"a",}', "not_json"),
    ('["Event"]', "missing_event"),
    ('"Event"', "missing_event"),
    ("5", "missing_event"),
    ("null", "missing_event"),
    ('{"x":{"Event":1}}', "missing_event"),
    ('{"NotEvent":1}', "missing_event"),
]


def test_line_verdicts(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, value string")
    found = {r.i: r.verdict for r in with_verdict(df).collect()}
    assert found == {i: c[1] for i, c in enumerate(CASES)}


def test_lines_have_no_length_limit(spark):
    start = F.lit('{"Event":"a","x":["')
    letter = F.when(F.col("id") >= 0, "y")  # no constant: it would travel in the plan
    long_string = F.repeat(letter, 21_000_000)
    long_line = F.array_join(F.array_repeat(F.repeat(letter, 1_000_000), 140), '","')
    for text in (long_string, long_line):
        line = spark.range(1).select(F.concat(start, text, F.lit('"]}')).alias("value"))
        cut = line.select(F.concat(F.col("value"), F.lit("}")).alias("value"))
        assert [r.verdict for r in with_verdict(line.union(cut)).select("verdict").collect()] == ["ok", "not_json"]


def test_invalid_utf8_is_no_event_line(spark):
    raw = spark.createDataFrame([(bytearray(b'{"Event":"\xff\xfe"}'),)], "value binary")
    rows = with_verdict(raw.select(F.col("value").cast("string").alias("value"))).collect()
    assert rows[0].verdict == "not_utf8"


def log(tmp_path, name, text):
    path = tmp_path / name
    path.write_bytes(text if isinstance(text, bytes) else text.encode())
    return path


@pytest.mark.parametrize(
    "text, events, valid",
    [
        ('{"Event":"SparkListenerApplicationStart"}\n{"Event":"SparkListenerApplicationEnd"}\n', 2, True),
        ('{"Event":"a"}\nnot json\n', 1, False),
        ('{"x":1}\n', 0, False),
        ("\n  \n", 0, False),
        (b"\x28\xb5\x2f\xfd" + bytes(range(128, 256)), 0, False),
    ],
)
def test_validate_plain_log(spark, tmp_path, text, events, valid):
    path = log(tmp_path, "app", text)
    row = lines.count_events(lines.read_lines(spark, str(path)), "path").collect()[0]
    assert (row.n_events, row.valid) == (events, valid)


def test_first_error_counts_blank_lines(spark, tmp_path):
    path = log(tmp_path, "app", '{"Event":"a"}\n\n{"Event":"b"}\r\noops\n{"x":1}\n')
    row = lines.first_error(lines.read_lines(spark, str(path))).collect()[0]
    assert (row.line_no, row.reason) == (4, "not_json")


def test_line_numbers_across_splits(spark, tmp_path):
    for name in ("one", "two"):
        log(tmp_path, name, "".join(f"{name} {i} {'x' * (i % 50)}\n" for i in range(1, 3001)))
    setting = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "10000")
    try:
        scanned = lines.read_lines(spark, str(tmp_path))
        assert scanned.select("path", "split").distinct().count() > 10
        rows = lines.numbered(scanned, scanned).collect()
    finally:
        spark.conf.set(setting, before)
    assert len(rows) == 6000
    assert all(int(r.value.split()[1]) == r.line_no for r in rows)


def test_staged_events_drop_bad_lines(spark, tmp_path):
    rows = [("a", 0, '{"Event":"SparkListenerJobEnd","Job ID":1}'), ("a", 1, "oops"), ("a", 2, " ")]
    df = spark.createDataFrame(rows, "log_id string, seq long, value string")
    staged = lines.stage_events(df, str(tmp_path / "events"))
    assert [(r.kind, r.seq) for r in staged.collect()] == [("SparkListenerJobEnd", 0)]


def model_verdict(line):
    """What the line is, by Python's own parser; None where the two parsers are
    known to differ (repeated keys, NaN and infinities)."""
    text = line.strip()
    if not text:
        return "blank"

    def pairs(found):
        if len({k for k, _ in found}) != len(found):
            raise LookupError
        return dict(found)

    def constant(name):
        raise LookupError

    try:
        record = json.loads(text, object_pairs_hook=pairs, parse_constant=constant)
    except LookupError:
        return None
    except ValueError:
        return "not_json"
    return "ok" if isinstance(record, dict) and "Event" in record else "missing_event"


def test_fuzzed_lines_agree_with_python(spark):
    rng = random.Random(11)
    seeds = [c[0] for c in CASES] + [
        '{"Event":"a","n":-1.5e3,"t":true,"s":"\\u00e9\\n","l":[{},[]],"o":{"k":null}}',
        '{"a":{"b":[1,2,{"c":"d"}]},"Event":""}',
        '[{"Event":1},0]',
    ]
    alphabet = '{}[]",:0123456789eE+-.\\ntrufalsEvn x\t'
    lines_in = []
    for _ in range(4000):
        text = list(rng.choice(seeds))
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(text) + 1)
            action = rng.randrange(3)
            if action == 0:
                text.insert(at, rng.choice(alphabet))
            elif text and at < len(text):
                if action == 1:
                    del text[at]
                else:
                    text[at] = rng.choice(alphabet)
        lines_in.append("".join(text))
    df = spark.createDataFrame(list(enumerate(lines_in)), "i int, value string")
    found = {r.i: r.verdict for r in with_verdict(df).collect()}
    wrong = [
        (line, found[i], model_verdict(line))
        for i, line in enumerate(lines_in)
        if model_verdict(line) not in (None, found[i])
    ]
    assert not wrong, wrong[:10]


def test_staged_lines_are_packed_with_zstd(spark, tmp_path):
    import pyarrow.parquet as pq

    from tracewright.sources.lines import stage_events

    lines = spark.range(50).selectExpr("'a' AS log_id", "id AS seq", """'{"Event":"x","n":' || id || '}' AS value""")
    assert stage_events(lines, str(tmp_path / "staged")).count() == 50
    kinds = {
        pq.ParquetFile(f).metadata.row_group(0).column(0).compression
        for f in (tmp_path / "staged").glob("*.parquet")
        if pq.ParquetFile(f).metadata.num_rows
    }
    assert kinds == {"ZSTD"}


def test_only_the_parse_is_behind_the_generator(spark):
    """A generator is not compiled: verdicts made inside it cost as much as the parse.
    A filter on the verdict must not repeat the parse either."""
    judged = with_verdict(spark.createDataFrame([('{"Event":"a"}',), ("x",)], "value string"))
    plan = judged.where("verdict = 'ok'")._jdf.queryExecution().executedPlan().toString()
    made = [row for row in plan.splitlines() if "Generate inline" in row]
    assert len(made) == 1 and "missing_event" not in made[0]
    assert plan.count("StructField(Event,StringType") == 1
    assert [r.event for r in judged.where("verdict = 'ok'").collect()] == ["a"]
