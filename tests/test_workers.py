"""Python workers import the package wherever the driver was started."""

import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from tests.compare import session
from __spark_entry__ import queries
spark = session()
for name in ("decode_event_counts", "dir_checksum", "partition_profile"):
    assert queries()[name](spark, "/root/testdata/sf0.001").count() > 0
spark.stop()
"""


def test_queries_from_another_folder(tmp_path):
    repo = str(Path(__file__).resolve().parent.parent)
    command = [sys.executable, "-c", SCRIPT.format(repo=repo)]
    done = subprocess.run(command, cwd=tmp_path, timeout=300, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-2000:]
