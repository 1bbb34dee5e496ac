"""What workers and checkpoints need, whatever the master."""

import os
import subprocess
import sys
from pathlib import Path

from pyspark.sql import functions as F

from tallyloom.operators import lineage

REPO = Path(__file__).resolve().parent.parent


def test_queries_run_from_another_folder(tables, tmp_path):
    code = (
        "import importlib.util as u\n"
        f"s = u.spec_from_file_location('e', '{REPO}/__spark_entry__.py')\n"
        "m = u.module_from_spec(s); s.loader.exec_module(m)\n"
        "from pyspark.sql import SparkSession\n"
        "spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        f"print('ROWS', m.queries()['kmeans_step'](spark, '{tables}').count())\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert "ROWS 640" in done.stdout, done.stderr[-2000:]


class _Context:
    def __init__(self):
        self.folder = None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class _Session:
    def __init__(self, named=None):
        self.sparkContext = _Context()
        self.settings = {"spark.checkpoint.dir": named, "spark.sql.warehouse.dir": "/w/house"}
        self.conf = self

    def get(self, key, default=None):
        return self.settings.get(key) or default


def test_one_rule_for_checkpoint_folders():
    session = _Session("/shared/named")
    assert lineage.ensure_checkpoint_dir(session) == "/shared/named"
    session.sparkContext.folder = "/shared/set"
    assert lineage.ensure_checkpoint_dir(session) == "/shared/set"
    assert lineage.ensure_checkpoint_dir(_Session()) == "/w/house/_checkpoints"


def test_stored_rows_come_back(spark):
    df = spark.range(10).withColumn("x", F.array("id"))
    assert sorted(lineage.stored(df).collect()) == sorted(df.collect())


def test_bucketed_table_is_not_shuffled(spark):
    """Only the other side of a join moves; no name stays in the catalog, and the table can be discarded."""
    wide = spark.createDataFrame([(k % 7, "w" * k) for k in range(40)] + [(None, "n")], "k LONG, t STRING")
    table = lineage.stored_by_key(wide, "k")
    assert sorted(table.collect(), key=str) == sorted(wide.collect(), key=str)
    assert spark.sql("SHOW TABLES").filter(f"tableName LIKE '{lineage.STORED_NAME}%'").count() == 0
    joined = table.join(spark.range(5).withColumnRenamed("id", "k").groupBy("k").count().hint("merge"), "k", "left")
    assert joined._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert joined.count() == 41 and joined.filter("count = 1").count() == sum(k % 7 < 5 for k in range(40))
    lineage.discard(table)
    empty = lineage.stored_by_key(wide.limit(0), "k")
    assert empty.columns == ["k", "t"] and empty.collect() == []
