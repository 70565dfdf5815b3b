import hashlib

import pytest
from pyspark.sql import functions as F

from tests.encode import zstd
from tracewright.functions.text import codec_of, path_parts, stem
from tracewright.sources import files as listing
from tracewright.sources import layout

SCHEMA = "log_id string, name string, is_file boolean, is_dir_log boolean"


def rolling(spark, *names):
    return spark.createDataFrame([("log", n, True, True) for n in names], SCHEMA)


@pytest.mark.parametrize(
    "names, error",
    [
        (["appstatus_a", "events_1_a.zstd", "events_2_a.zstd"], None),
        (["appstatus_a"], "no event files"),
        (["events_1_a"], "no marker file"),
        (["appstatus_a", "events_1_a", "events_3_a"], "event file indexes are not 1..2"),
        (["appstatus_a", "events_1_a", "events_1_b"], "event file indexes are not 1..2"),
        (["appstatus_a", "events_2_a"], "event file indexes are not 1..1"),
        (["appstatus_a", "events_1_a", "events_2_a.zstd"], "event files mix codecs none, zstd"),
        (["appstatus_a", "events_1_"], "no event files"),
    ],
)
def test_rolling_layout(spark, names, error):
    row = layout.log_layout(rolling(spark, *names)).collect()[0]
    assert row.error == error
    if error is None:
        assert (row.layout, row.compression) == ("rolling-dir", "zstd")


def test_event_files_order_by_number(spark):
    names = ["appstatus_a", *(f"events_{i}_a" for i in range(1, 12))]
    rows = layout.rolling_file_order(rolling(spark, *names)).collect()
    assert [r.idx for r in rows] == list(range(1, 12))


def test_a_folder_is_no_event_file(spark):
    rows = [("log", "appstatus_a", True, True), ("log", "events_1_a", False, True)]
    found = layout.rolling_dir_check(spark.createDataFrame(rows, SCHEMA)).collect()[0]
    assert found.error == "no event files"


@pytest.mark.parametrize(
    "name, codec",
    [
        ("a", "none"), ("a.zstd", "zstd"), ("a.lz4", "lz4"), ("a.snappy", "snappy"),
        (".zstd", "none"), ("x/.zstd", "none"), ("a.zstd.crc", "none"), ("a.b.lz4", "lz4"),
    ],
)
def test_codec_of(spark, name, codec):
    assert spark.createDataFrame([(name,)], "p string").select(codec_of("p")).first()[0] == codec


def test_stem_and_parts(spark):
    df = spark.createDataFrame([("a/b.c.json",), ("a/.hidden",), ("plain",)], "p string")
    assert [r[0] for r in df.select(stem("p")).collect()] == ["b.c", ".hidden", "plain"]
    paths = spark.createDataFrame([("a-b",), ("a/b",)], "p string").orderBy(path_parts("p"))
    assert [r[0] for r in paths.collect()] == ["a/b", "a-b"]


@pytest.mark.parametrize(
    "name, is_dir, path",
    [
        ("local-1", False, "logs/run.ndjson"),
        ("local-1.zstd", False, "logs/run.zstd"),
        ("eventlog_v2_app", True, "logs/run/eventlog_v2_app"),
    ],
)
def test_log_relpath(spark, name, is_dir, path):
    df = spark.createDataFrame([("run", is_dir, name)], "id string, d boolean, n string")
    assert df.select(layout.log_relpath("id", "d", "n")).first()[0] == path


def corpus(tmp_path):
    root = tmp_path / "corpus"
    log = root / "eventlog_v2_app"
    (log / "sub").mkdir(parents=True)
    (log / "events_1_app.zstd").write_bytes(zstd(b'{"Event":"a"}\n'))
    (log / "appstatus_app").write_bytes(b"")
    (log / ".appstatus_app.crc").write_bytes(b"crc")
    (log / "sub" / "x").write_bytes(b"1")
    (log / "sub-x").write_bytes(b"2")
    (root / "single").write_bytes(b"hello")
    return root, log


def manifest_digest(log):
    found = sorted(p for p in log.rglob("*") if p.is_file())
    lines = "".join(
        f"{p.relative_to(log).as_posix()}\0{hashlib.sha256(p.read_bytes()).hexdigest()}\n"
        for p in found
    )
    return f"sha256:{hashlib.sha256(lines.encode()).hexdigest()}"


def test_listing_sizes_and_checksums(spark, tmp_path):
    root, log = corpus(tmp_path)
    found = listing.list_logs(spark, [str(root)])
    sizes = {r.log_id: r.size_bytes for r in layout.log_size(found).collect()}
    wanted = sum(p.stat().st_size for p in log.rglob("*") if p.is_file())
    assert sizes == {"single": 5, "eventlog_v2_app": wanted}
    sums = {r.log_id: r.checksum for r in listing.log_checksums(found).collect()}
    assert sums["single"] == f"sha256:{hashlib.sha256(b'hello').hexdigest()}"
    assert sums["eventlog_v2_app"] == manifest_digest(log)
    kinds = {r.log_id: (r.layout, r.compression, r.error) for r in layout.log_layout(found).collect()}
    assert kinds == {
        "single": ("single-file", "none", None),
        "eventlog_v2_app": ("rolling-dir", "zstd", None),
    }


@pytest.mark.parametrize("change", ["content", "name"])
def test_directory_checksum_sees_changes(spark, tmp_path, change):
    root, log = corpus(tmp_path)
    before = listing.log_checksums(listing.list_logs(spark, [str(root)])).collect()
    if change == "content":
        (log / "sub-x").write_bytes(b"3")
    else:
        (log / "sub-x").rename(log / "sub-y")
    after = listing.log_checksums(listing.list_logs(spark, [str(root)])).collect()
    changed = {r.log_id for r in set(before) ^ set(after)}
    assert changed == {"eventlog_v2_app"}


def test_many_files_are_listed_hashed_and_copied(spark, tmp_path):
    """More files than tasks, so that a task filters a batch of several."""
    for n in range(60):
        (tmp_path / "in" / f"dir{n % 3}").mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / f"log{n}").write_text(f"log {n}\n" * (n % 4))
        (tmp_path / "in" / f"dir{n % 3}" / f"part{n}").write_text(f"part {n}\n")
    listed = listing.list_logs(spark, [str(tmp_path / "in")]).repartition(2)
    rows = listed.collect()
    assert len(rows) == 120 and sum(r.is_dir_log for r in rows) == 60
    assert {r.length for r in rows if r.name == "log3"} == {3 * len("log 3\n")}
    hashed = {r.name: r.digest for r in listing.with_digests(listed).collect()}
    assert hashed["part7"] == hashlib.sha256(b"part 7\n").hexdigest()
    stored = listing.store_files(listed.withColumn("dest", F.concat(F.lit("to/"), "name")), str(tmp_path / "out"))
    assert {r.name: r.digest for r in stored.collect()} == hashed
    assert len(list((tmp_path / "out" / "to").iterdir())) == 120
