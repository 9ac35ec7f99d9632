"""Queries run from any folder and without any Spark settings.

Python workers then start without this package on their path, and no scratch
folder is named.
"""

import os
import subprocess
import sys

import pytest
from conftest import ROOT, SF_DIR

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
import __spark_entry__ as entry
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
for name in ("extract_documents", "label_documents", "csv_round_trip"):
    print(name, entry.queries()[name](spark, {sf!r}).count() > 0)
"""


def test_queries_run_from_any_folder(tmp_path):
    script = SCRIPT.format(root=str(ROOT), sf=SF_DIR)
    env = {**os.environ, "SPARK_CONF_DIR": str(tmp_path)}
    done = subprocess.run(
        [sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=180
    )
    assert done.stdout.split() == ["extract_documents", "True", "label_documents", "True", "csv_round_trip", "True"], done.stderr[-2000:]


MEMORY = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from labelmill.operators.labelling import label_documents
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
spark.conf.set("spark.sql.shuffle.partitions", "1")

def labeler(request):
    with open("/proc/self/statm") as f:
        return '{{"content_summary": "' + f.read().split()[1] + '"}}'

def pages(n, store):
    long = F.repeat(F.sha2(F.col("id").cast("string"), 256), 200).alias("full_text")
    docs = spark.range(0, n, 1, 1).select(F.col("id").cast("string").alias("uri"), F.lit("").alias("part"), long)
    held = label_documents(docs, labeler, "2024-01-29", store=store)
    return held.agg(F.max(F.col("content_summary").cast("long"))).first()[0]

stores = {stores!r}
few = pages(10, stores[0])
print((pages(6000, stores[1]) - few) * 4096 // 2**20)
"""


@pytest.mark.parametrize("stored", [True, False])
def test_labelling_holds_few_requests(tmp_path, stored):
    """A worker with 6,000 requests, 60 MB, takes little more memory than one with ten."""
    stores = [str(tmp_path / s) if stored else None for s in ("few", "many")]
    script = MEMORY.format(root=str(ROOT), stores=stores)
    env = {**os.environ, "SPARK_CONF_DIR": str(tmp_path)}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=180)
    assert done.returncode == 0 and int(done.stdout) < 20, done.stdout + done.stderr[-2000:]
