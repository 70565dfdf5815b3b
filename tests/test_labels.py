import json

import pytest

from tracewright.operators import labels
from tracewright.sources import reports

FULL = {
    "schemaVersion": 1,
    "findings": [{"id": "1", "type": "a", "tag": t} for t in ("SKEW", "STRAG", "SKEW")],
    "cleanChecks": [{"type": "a", "tag": "SPEC"}, {"type": "a", "tag": "HOST"}],
}


@pytest.mark.parametrize(
    "report, fired, error",
    [
        (json.dumps(FULL), ["SKEW", "STRAG"], None),
        ('{"findings":[],"cleanChecks":[{"tag":"SKEW"}]}', [], None),
        ('{"schemaVersion":1}', None, reports.NO_FINDINGS),
        ('{"findings":{"tag":"SKEW"}}', None, reports.NO_FINDINGS),
        ('{"findings":[{"id":"1"}]}', None, reports.UNTAGGED),
        ('{"findings":[{"tag":""}]}', None, reports.UNTAGGED),
        ('{"findings":[{"tag":5}]}', None, reports.UNTAGGED),
        ('{"findings":["SKEW"]}', None, reports.UNTAGGED),
        ("oops", None, reports.NOT_JSON),
        (None, None, reports.NOT_JSON),
    ],
)
def test_fired_tags(spark, report, fired, error):
    row = reports.fired_tags(spark.createDataFrame([(report,)], "report string")).first()
    assert (row.fired, row.error) == (fired, error)


def test_missing_targets_keep_order_and_repeats(spark):
    df = spark.createDataFrame([(["C", "A", "B", "C"], ["A"])], "t array<string>, f array<string>")
    assert df.select(labels.missing_targets("t", "f")).first()[0] == ["C", "B", "C"]


CATALOG = "id string, source string, path string, checksum string, targets_detectors array<string>"
REPORTS = "id string, exit_code int, message string, report string"


def scores(spark, entry=("run", "self-generated", "p", "c", ["SKEW", "SPEC"]), log=("p", "c"), report=None):
    report = report or ("run", 0, "", json.dumps(FULL))
    return labels.label_score(
        spark.createDataFrame([entry], CATALOG),
        spark.createDataFrame([log] if log else [], "path string, checksum string"),
        spark.createDataFrame([report], REPORTS),
    )


def test_scored_entry(spark):
    found = scores(spark)
    row = found.first()
    assert (row.missing, row.fired, row.error) == (["SPEC"], ["SKEW", "STRAG"], None)
    assert labels.label_verdict(found).first().verdict == 1
    assert labels.label_report(found).first().line == "MISSED: run: SPEC did not fire (fired: SKEW, STRAG)"
    totals = labels.label_totals(found).first()
    assert (totals.fired, totals.targeted) == (1, 2)


def test_inconclusive_exit_is_a_full_report(spark):
    assert scores(spark, report=("run", 3, "", json.dumps(FULL))).first().error is None


@pytest.mark.parametrize(
    "options, error",
    [
        ({"log": None, "report": ("run", 1, "x", "oops")}, "log not found: p"),
        ({"log": ("p", "other"), "report": ("run", 1, "x", "oops")}, "checksum differs from catalog: p"),
        ({"report": ("run", 1, " bad input\n ", "oops")}, "analyzer exited 1: bad input"),
        ({"report": ("run", 0, "", "{}")}, reports.NO_FINDINGS),
        ({"report": ("another", 0, "", "{}")}, "no report"),
    ],
)
def test_first_failing_check_is_the_error(spark, options, error):
    found = scores(spark, **options)
    row = found.first()
    assert row.error.strip() == error and row.missing is None
    assert labels.label_verdict(found).first().verdict == 2


@pytest.mark.parametrize("source", ["external", None])
def test_other_sources_are_left_alone(spark, source):
    assert scores(spark, entry=("run", source, "p", "c", [])).count() == 0


def test_verdict_without_problems(spark):
    found = scores(spark, entry=("run", "self-generated", "p", "c", ["SKEW"]))
    assert labels.label_verdict(found).first().verdict == 0
    assert labels.label_report(found).first().line == "ok: run"
