import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
from __spark_entry__ import queries
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
known = queries()
for name in ("V1_vector_range", "V3_vector_join_topk", "S20_text_scan", "S22_archive_scan", "K14_custom_sink"):
    assert known[name](spark, "/root/testdata/sf0.001").count() > 0, name
print("all ran")
"""


def test_tasks_run_where_the_package_is_not_installed(tmp_path):
    """A plain session in another folder: the workers cannot import this package."""
    script = tmp_path / "run.py"
    script.write_text(SCRIPT.format(root=str(ROOT)))
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "all ran" in done.stdout, done.stderr[-3000:]
