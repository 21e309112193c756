"""What is kept in the shared folder goes when nothing refers to it any more."""

import gc
import subprocess
import sys
import time
from pathlib import Path
from urllib.parse import urlparse

import pytest

from quantloom.functions.shared import checkpoint_folder, checkpointed


def rdds(spark):
    return {p.name for p in Path(urlparse(checkpoint_folder(spark)).path).glob("rdd-*")}


def test_a_checkpoint_goes_with_its_last_reader(spark):
    before = rdds(spark)
    df = checkpointed(spark.range(100))
    more = df.selectExpr("id + 1 as id")
    own = rdds(spark) - before
    assert len(own) == 1
    del df
    gc.collect()
    spark._jvm.System.gc()
    time.sleep(1)
    assert more.agg({"id": "sum"}).first()[0] == 5050 and own <= rdds(spark)
    del more
    for _ in range(20):
        gc.collect()
        spark.range(3).count()  # Python hands the JVM's objects back when it next talks to it
        spark._jvm.System.gc()
        time.sleep(0.5)
        if not own & rdds(spark):
            break
    assert not own & rdds(spark)


CODE = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
from quantloom.functions import shared
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", sys.argv[2]).getOrCreate()
if sys.argv[3] == "ours":
    type(spark.sparkContext).getCheckpointDir = lambda self, real=type(spark.sparkContext).getCheckpointDir, seen=[]: real(self) if seen else seen.append(1)
kept = shared.checkpointed(spark.range(3))
print("AT", spark.sparkContext._jsc.sc().getCheckpointDir().get())
"""


@pytest.mark.parametrize("owner", ["ours", "another's"])
def test_a_folder_of_our_own_goes_with_the_process(tmp_path, owner):
    (tmp_path / "named").mkdir()
    (tmp_path / "named/of-others").mkdir()
    run = subprocess.run([sys.executable, "-c", CODE, str(Path(__file__).parents[1]), f"file://{tmp_path}/named", owner], capture_output=True, text=True, timeout=120, check=True)
    at = Path(urlparse(run.stdout.split("AT ")[1].strip()).path)
    assert at.is_relative_to(tmp_path / "named") and at.exists() == (owner != "ours") and (tmp_path / "named/of-others").exists()
