"""Scans read from plan trees: nothing from text or old plans."""

import json

from tracewright.sources import tables

KIND = "org.apache.spark.sql.execution.ui."


def node(name, *children, location=None, text=""):
    metadata = {} if location is None else {"Location": f"InMemoryFileIndex(2 paths)[{location}]"}
    return {"nodeName": name, "simpleString": text, "children": list(children), "metadata": metadata, "metrics": []}


def event(seq, execution, plan, update=False, log="a"):
    name = tables.SQL_UPDATE if update else tables.SQL_START
    return (log, seq, json.dumps({"Event": KIND + name, "executionId": execution, "sparkPlanInfo": plan}))


def scans(spark, events):
    lines = spark.createDataFrame(events, "log_id string, seq long, value string")
    return {tuple(r) for r in tables.file_scans(lines).collect()}


def test_scans_of_the_last_plan(spark):
    decoy = '"Location":"InMemoryFileIndex(1 paths)[/decoy]"'
    deep = node("Scan parquet ", location="/deep")
    for _ in range(300):
        deep = node("Project", deep, text=decoy)
    cached = node("InMemoryTableScan", node("Scan csv ", location="/cached"))
    events = [
        event(1, 1, node("AdaptiveSparkPlan", node("Scan parquet ", location="/old"))),
        event(5, 1, node("AdaptiveSparkPlan", node("Join", node("Scan parquet ", location="/x, /y"), cached)), True),
        event(3, 1, node("AdaptiveSparkPlan", node("Scan parquet ", location="/older")), True),
        event(6, 2, deep),
        event(7, 3, node("LocalTableScan", location="/not-a-scan-node")),
        event(8, 4, node("Scan json ", location="/a, /b, ... 7 entries")),
        event(9, 5, node("Scan json ", location="/gone")),
        event(10, 5, None, True),
        event(11, 1, node("Scan orc ", location="/x"), log="b"),
        ("a", 12, f'{{"Event":"x","note":{json.dumps(decoy)}}}'),
    ]
    assert scans(spark, events) == {
        ("a", 1, "/x"), ("a", 1, "/y"), ("a", 1, "/cached"), ("a", 2, "/deep"), ("a", 4, "/a"), ("a", 4, "/b"), ("b", 1, "/x"),
    }


def test_nodes_know_their_parents(spark):
    plan = node("A", node("B", node("C")), node("D"))
    lines = spark.createDataFrame([event(1, 7, plan)], "log_id string, seq long, value string")
    found = sorted((r.node, r.parent, r.depth, r.name) for r in tables.plan_nodes(lines).collect() if r.node)
    assert found == [(1, 0, 1, "B"), (2, 1, 2, "C"), (3, 0, 1, "D")]


def test_damaged_plans(spark):
    events = [event(1, 1, "text"), event(2, 2, [1]), event(3, 3, {"nodeName": 4, "children": 5, "metadata": 6})]
    assert scans(spark, events) == set()


def test_plans_are_walked_once(spark, capsys):
    """Of tied last plans all scans count; the plans pass one Python stage."""
    def line(execution, location):
        leaf = {"nodeName": "Scan parquet", "metadata": {"Location": f"InMemoryFileIndex(1 paths)[{location}]"}}
        event = "org.apache.spark.sql.execution.ui.SparkListenerSQLExecutionStart"
        return json.dumps({"Event": event, "executionId": execution, "sparkPlanInfo": leaf})

    rows = [("a", 1, line(1, "/old")), ("a", 2, line(1, "/x")), ("a", 2, line(1, "/y")), (None, 1, line(1, "/z"))]
    rows.append(("a", 3, f"[{line(1, '/list')}]"))
    found = tables.file_scans(spark.createDataFrame(rows, "log_id string, seq long, value string"))
    found.explain()
    assert capsys.readouterr().out.count("MapInArrow") == 1
    assert sorted(map(tuple, found.collect())) == [("a", 1, "/x"), ("a", 1, "/y")]
