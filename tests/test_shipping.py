"""Started elsewhere, Python workers find the package after ``ship``."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession, functions as F
from vigil.functions import markup
from vigil.plans.shipping import ship
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
ship(spark)
print("TEXT", spark.createDataFrame([("<p>a&hellip;</p>",)], "t string").select(markup.clean_text(F.col("t"))).first()[0])
"""


def test_workers_outside_the_repository(tmp_path):
    out = subprocess.run([sys.executable, "-c", SCRIPT, str(ROOT)], cwd=tmp_path, capture_output=True, text=True, timeout=120, check=False)
    assert "TEXT a…" in out.stdout, out.stderr[-2000:]
