import os
import subprocess
import sys
import textwrap
from pathlib import Path

REPO = Path(__file__).resolve().parent.parent

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
{body}
spark.stop()
"""


def run_without_package(body: str, folder: Path) -> str:
    """Run code whose driver finds the package by ``sys.path`` only: Python workers don't have it."""
    script = folder / "run.py"
    script.write_text(SCRIPT.format(repo=str(REPO), body=textwrap.dedent(body)))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=folder, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-3000:]
    return done.stdout


def test_shared_objects_need_no_package_on_executors(tmp_path):
    body = """
    from stockloom.operators.isolation import IsolationForestModel
    from stockloom.shipping import share

    load = share(spark.sparkContext, IsolationForestModel(["x"], 2, []))

    @F.udf("string")
    def names(i):
        import importlib.util
        return f"{load().features} {load() is load()} {importlib.util.find_spec('stockloom') is None}"

    print(spark.range(1).select(names("id")).first()[0])
    """
    assert "['x'] True True" in run_without_package(body, tmp_path)
