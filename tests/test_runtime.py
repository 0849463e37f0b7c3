"""Stored tables: where they lie and when they go."""

import os
import subprocess
import sys
from pathlib import Path

from shoptrail import runtime

ROOT = str(Path(__file__).resolve().parent.parent)
SCRIPT = """
import sys
from shoptrail.runtime import build_session, stored
spark = build_session("t", master="local[1]", spark__ui__enabled="false", spark__checkpoint__dir=sys.argv[1])
rows = stored(spark.range(3), "some rows")
print(rows.count(), rows.inputFiles()[0])
spark.stop()
"""


def test_temporary_tables_go_with_their_caller(spark):
    with runtime.temporary_tables(spark):
        inner = runtime.stored(spark.range(5), "numbers")
        files = inner.inputFiles()
        assert inner.count() == 5 and files
    folder = files[0].rsplit("/", 1)[0]
    assert not runtime.path_exists(spark, folder)
    outside = runtime.stored(spark.range(5), "numbers").inputFiles()
    assert runtime.path_exists(spark, outside[0])


def test_nothing_is_left_behind_by_a_session(tmp_path):
    done = subprocess.run([sys.executable, "-c", SCRIPT, str(tmp_path)], capture_output=True, text=True, timeout=300, cwd=ROOT)
    count, file = done.stdout.split()
    assert count == "3" and f"{tmp_path}/" in file
    assert [f for _, _, names in os.walk(tmp_path) for f in names] == []


def test_folders_lie_below_the_warehouse_where_no_checkpoint_folder_is_set():
    class Session:
        def __init__(self, **settings):
            self.settings, self.conf = settings, self

        def get(self, key, *default):
            return self.settings.get(key.replace(".", "_"), *default)

    warehouse = {"spark_sql_warehouse_dir": "hdfs://x/warehouse/"}
    assert runtime.work_folder(Session(**warehouse), "a b").startswith("hdfs://x/warehouse/shoptrail-work/a-b-")
    assert runtime.work_folder(Session(spark_checkpoint_dir="hdfs://x/c", **warehouse), "a").startswith("hdfs://x/c/a-")


def test_no_machine_local_folders():
    sources = [p for p in Path(ROOT, "shoptrail").rglob("*.py") if "llm" not in p.parts]
    assert sources and not [p for p in sources if "tempfile" in p.read_text()]
