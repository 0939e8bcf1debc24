"""The shared folder, in sessions of their own process."""

from __future__ import annotations

import os
import subprocess
import sys

from helpers import ROOT

SCRIPT = """
from pyspark.sql import SparkSession
builder = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
builder = builder.config("spark.sql.warehouse.dir", {warehouse!r})
if {folder!r}:
    builder = builder.config("spark.checkpoint.dir", {folder!r})
spark = builder.getOrCreate()
import __spark_entry__ as e
from tableferry.session import remove_path, work_dir
print("ROWS", e.queries()["add_id_new"](spark, "/root/testdata/sf0.001").count())
print("ROWS", e.queries()["upload_full"](spark, "/root/testdata/sf0.001").count())
print("DIR", work_dir(spark), work_dir(spark) == work_dir(spark))
try:
    remove_path(spark, "/tmp/other")
except ValueError:
    print("REFUSED")
spark.stop()
"""


def run(tmp_path, folder):
    script = SCRIPT.format(folder=folder, warehouse=str(tmp_path / "warehouse"))
    # An empty configuration folder, so that only the script names the shared folder.
    env = {**os.environ, "PYTHONPATH": ROOT, "SPARK_CONF_DIR": str(tmp_path)}
    done = subprocess.run(
        [sys.executable, "-c", script], capture_output=True, text=True, cwd=tmp_path, env=env, timeout=300
    )
    assert done.returncode == 0, done.stderr[-2000:]
    assert "REFUSED" in done.stdout and done.stdout.count("ROWS") == 2
    return done.stdout


def test_the_named_folder_is_used(tmp_path):
    folder = str(tmp_path / "shared")
    assert f"DIR {folder} True" in run(tmp_path, folder)
    assert os.listdir(folder)


def test_a_local_session_falls_back(tmp_path):
    out = run(tmp_path, "")
    assert "True" in out and "/run-" in out
    assert not (tmp_path / "spark-warehouse").exists()
