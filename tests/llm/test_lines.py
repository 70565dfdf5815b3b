import textwrap

import pytest

from tests.llm.rows import empty, odd, odd_rows
from tracewright.llm import boilerplate, licences


def brute(rows, ratio=0.1, least=5):
    """Text and dropped lines by host, from (id, text, host)."""
    strip = " \t\x0b\f\r"
    pages, seen = {}, {}
    for _, text, host in rows:
        pages[host] = pages.get(host, 0) + 1
        for line in {x.strip(strip) for x in (text or "").split("\n")} - {""}:
            seen[host, line] = seen.get((host, line), 0) + 1
    out = []
    for key, text, host in rows:
        if text is None:
            out.append((key, None, 0))
            continue
        lines = text.split("\n")
        kept = [
            x for x in lines
            if not (seen.get((host, x.strip(strip)), 0) >= least and seen[host, x.strip(strip)] > ratio * pages[host])
        ]
        out.append((key, "\n".join(kept), len(lines) - len(kept)))
    return out


def test_lines_of_a_site(spark):
    rows = []
    for n in range(90):
        lines = [f"own {n}", "", " shared \t" if n % 2 else "shared", f"own {n}"]
        if n % 30 == 0:
            lines.append("rare")
        rows.append((n, "\n".join(lines), ("x", "y", None)[n % 3]))
    rows += [(n, "shared\nshared", "small") for n in range(100, 104)] + [(200, None, "x"), (201, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = boilerplate.without_boilerplate(docs, docs["source"]).collect()
    wanted = brute(rows)
    assert sorted((r.doc_id, r.text, r.n_dropped) for r in found) == sorted(wanted)
    assert sum(w[2] for w in wanted) == 90


def test_both_join_plans_agree(spark):
    rows = [(n, "same\nown " + str(n), str(n % 3)) for n in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    results = []
    for limit in ("-1", "10m"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        found = boilerplate.without_boilerplate(docs, docs["source"])
        results.append(sorted(tuple(r) for r in found.collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert results[0] == results[1]


def test_odd_rows(spark):
    docs = odd(spark)
    found = boilerplate.without_boilerplate(docs, docs["source"])
    assert found.columns == [*docs.columns, "n_dropped"]
    assert found.count() == len(odd_rows())
    clash = docs.withColumnRenamed("part", "n_dropped")
    assert boilerplate.without_boilerplate(clash, clash["source"]).columns.count("n_dropped") == 1
    none = empty(spark)
    assert boilerplate.without_boilerplate(none, none["source"]).count() == 0
    assert licences.scan(docs).count() == 0
    assert licences.scan(empty(spark)).count() == 0


MIT = " ".join(text for name, text in licences.SENTENCES if name in ("mit-grant", "mit-notice-kept", "mit-asis"))
BSD = "\n".join(text for name, text in licences.SENTENCES if name.startswith("bsd-"))


@pytest.mark.parametrize(
    ("text", "wanted"),
    [
        ("Some words.\nReleased under the MIT License.\nMore.", "MIT"),
        ("x\nLICENSED under   the Apache License, version 2.0.", "Apache-2.0"),
        (MIT, "MIT"),
        (BSD, "BSD-3-Clause"),
        (BSD.rsplit("\n", 1)[0], "BSD-2-Clause"),
        ("\n".join(reversed(BSD.split("\n"))), ""),
        ("Licensed under CC BY-NC 4.0.\nReleased under the MIT License.", "CC-BY-NC-4.0 MIT"),
        ("This is not released under the MIT License.", None),
    ],
)
def test_rules_read_sentences_in_order(spark, text, wanted):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    found = licences.scan(docs).collect()
    assert [r.licences for r in found] == ([] if wanted is None else [wanted])


def wrapped(text, width=72, mark=""):
    return "\n".join(mark + line for part in text.split("\n") for line in textwrap.wrap(part, width))


def known(*names):
    return "\n".join(text for name, text in licences.SENTENCES if name in names)


@pytest.mark.parametrize(
    ("text", "wanted"),
    [
        ("MIT License\n\nCopyright 2020 A\n\n" + wrapped(MIT), "MIT"),
        ("Copyright 2020 A\n" + wrapped(BSD, 70), "BSD-3-Clause"),
        ("/*\n * Copyright\n *\n" + wrapped(known("gpl-free", "gpl-redistribute2", "gpl-useful"), 60, " * ") + "\n */", "GPL-2.0-or-later"),
        (wrapped(known("gpl-free", "gpl-redistribute3", "gpl-useful"), 30, "# "), "GPL-3.0-or-later"),
        (wrapped(known("cc0-notice"), 40, "// "), "CC0-1.0"),
        (wrapped(known("mpl2-notice"), 40, "; ").replace("\n", "\r\n"), "MPL-2.0"),
        ("Title\nReleased under the MIT License\nnext line", "MIT"),
        ("To the extent possible under law, the author has dedicated all\n\n" + known("cc0-notice").split("all ", 1)[1], None),
    ],
)
def test_wrapped_sentences(spark, text, wanted):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    found = licences.scan(docs).collect()
    assert [r.licences for r in found] == ([] if wanted is None else [wanted])


def test_sentences_of_one_line_are_found_once(spark):
    text = "Released under the MIT License.\nReleased under the MIT License\nLicensed under CC BY-NC 4.0. MIT License"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert [r.sentences for r in licences.scan(docs).collect()] == ["mit-notice mit-notice ccbync4-notice mit-title"]


@pytest.mark.parametrize("name", ["boilerplate", "licences"])
def test_native(spark, name):
    docs = odd(spark)
    found = licences.scan(docs) if name == "licences" else boilerplate.without_boilerplate(docs, docs["source"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_clashing_columns(spark):
    """Columns of the input may have any name, also those used inside."""
    docs = spark.createDataFrame(
        [(n, f"same line\nown {n}", "h", "a", "b", "c") for n in range(12)],
        "doc_id long, text string, source string, lines string, host string, HOST_ string",
    )
    found = boilerplate.without_boilerplate(docs, docs["source"])
    assert found.columns == [*docs.columns, "n_dropped"]
    assert {(r.text, r.lines, r.host) for r in found.collect()} == {(f"own {n}", "a", "b") for n in range(12)}
