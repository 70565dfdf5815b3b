"""The data source: large files in several partitions, filters by the listing."""

import json
import re
import subprocess
import sys
from pathlib import Path

import pytest
import zstandard
from pyspark.sql import functions as F

from tests.encode import ENCODERS
from tracewright.sources import decode, lines, logsource


def frames(data, size=700):
    """zstd as a stream that is flushed often: many frames in one file."""
    return b"".join(zstandard.ZstdCompressor().compress(data[n : n + size]) for n in range(0, len(data), size))


WANTED = [json.dumps({"Event": f"e{n}", "text": "é" * (n % 50)}) for n in range(1500)]
DATA = "".join(f"{line}\n" for line in WANTED).encode()


@pytest.mark.parametrize("suffix", ENCODERS)
def test_one_large_file_is_many_partitions(spark, tmp_path, suffix):
    encode = frames if suffix == ".zstd" else ENCODERS[suffix]
    (tmp_path / f"big{suffix}").write_bytes(encode(DATA))
    found = logsource.read_logs(spark, str(tmp_path), chunk_bytes=3000)
    rows = sorted(found.collect(), key=lambda r: (r.split, r.ordinal))
    assert [r.value for r in rows] == WANTED and all(r.error is None for r in rows)
    assert found.rdd.getNumPartitions() > 4
    assert found.withColumn("p", F.spark_partition_id()).select("p").distinct().count() > 4
    scanned = sorted(r.value for r in spark.read.text(str(tmp_path)).collect()) if suffix in ("", ".zstd") else None
    assert scanned is None or scanned == sorted(WANTED)


def test_rolling_logs_and_filters(spark, tmp_path):
    inner = tmp_path / "eventlog_v2_app"
    inner.mkdir()
    for n in (1, 2, 10):
        (inner / f"events_{n}_app.lz4").write_bytes(ENCODERS[".lz4"](f'{{"Event":"{n}"}}\n'.encode()))
    for name in ("appstatus_app", ".hidden", "other"):
        (inner / name).write_text("no event line\n")
    (tmp_path / "appstatus_x").write_text("no log\n")
    (tmp_path / "plain").write_text('{"Event":"p"}\n')
    (tmp_path / "broken.lz4").write_bytes(b"\x00" * 40)
    found = logsource.read_logs(spark, str(tmp_path))
    good = sorted((r.log_id, r.file_index, r.value) for r in found.where("error IS NULL").collect())
    assert good == [
        ("eventlog_v2_app", 1, '{"Event":"1"}'), ("eventlog_v2_app", 2, '{"Event":"2"}'),
        ("eventlog_v2_app", 10, '{"Event":"10"}'), ("plain", 0, '{"Event":"p"}'),
    ]
    assert [r.log_id for r in found.where("error IS NOT NULL").collect()] == ["broken.lz4"]
    one = found.where("log_id = 'plain'")
    assert one.rdd.getNumPartitions() == 1 and [r.value for r in one.collect()] == ['{"Event":"p"}']
    two = found.where("log_id IN ('plain', 'gone') AND value LIKE '%p%'")
    assert two.count() == 1 and found.where("log_id = 'gone'").count() == 0


@pytest.mark.parametrize("cut", [1, 5, 300, 2000])
def test_a_truncated_zstd_log_keeps_its_earlier_lines(spark, tmp_path, cut):
    (tmp_path / "log.zstd").write_bytes(frames(DATA)[:-cut])
    rows = logsource.read_logs(spark, str(tmp_path), chunk_bytes=2000).collect()
    assert sum(r.error is not None for r in rows) == 1
    values = [r.value for r in sorted(rows, key=lambda r: (r.split, r.ordinal)) if r.error is None]
    assert values[:-1] == WANTED[: len(values) - 1] and len(values) > 1000


def test_skippable_and_empty_frames(spark, tmp_path):
    skippable = (0x184D2A53).to_bytes(4, "little") + (3).to_bytes(4, "little") + b"abc"
    empty = zstandard.ZstdCompressor(write_checksum=True).compress(b"")
    big = zstandard.ZstdCompressor(write_content_size=False, write_checksum=True).compress(b"x" * 400_000 + b"\n")
    (tmp_path / "log.zstd").write_bytes(skippable + empty + big + skippable + frames(b"a\nb\n", 1) + empty)
    for chunk in (1, 50, 1 << 20):
        rows = logsource.read_logs(spark, str(tmp_path), chunk_bytes=chunk).collect()
        assert [r.value for r in sorted(rows, key=lambda r: (r.split, r.ordinal))] == ["x" * 400_000, "a", "b"]


def test_a_log_that_spark_wrote(spark, tmp_path):
    """Its zstd log holds many frames, and is read in several partitions."""
    repo = Path(__file__).resolve().parent.parent
    command = [sys.executable, "-m", "tests.make_logs", str(tmp_path), "zstd"]
    subprocess.run(command, cwd=repo, check=True, timeout=300, capture_output=True)
    (path,) = [p for p in tmp_path.iterdir() if re.search(r"\.zstd$", p.name) and not p.name.startswith(".")]
    assert len(decode.chunk_ranges(str(path), "zstd", 1)) > 20
    found = logsource.read_logs(spark, str(tmp_path), chunk_bytes=8000)
    assert found.rdd.getNumPartitions() > 4
    scanned = lines.read_lines(spark, str(path)).select("value")
    assert found.count() == scanned.count() > 200
    assert scanned.exceptAll(found.select("value")).count() == 0
