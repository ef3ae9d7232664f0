"""A task lost mid-job is retried and the dense keys stay exact.

Runs in its own Spark process (``local[4,4]`` allows task retries). A Python
UDF, used by the test only, fails the first attempt of one task in the stage
that reads the input, once for the range sampling and once for the sort and
write; the retried tasks recompute their partitions and the keys come out the
same as the plain numbering.
"""

import os
import subprocess
import sys
import textwrap

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = textwrap.dedent("""
    import sys
    sys.path.insert(0, {repo!r})
    from pyspark import TaskContext
    from pyspark.sql import SparkSession, Window, functions as F
    spark = (SparkSession.builder.master("local[4,4]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "4").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    from starweave.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    from starweave.operators.keys import dense_key

    @F.udf("long")
    def flaky(x):
        ctx = TaskContext.get()
        if ctx.attemptNumber() == 0 and ctx.partitionId() == 1:
            raise RuntimeError("simulated loss of an executor")
        return x

    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").repartition(4)
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    flaky_input = li.withColumn("l_orderkey", flaky("l_orderkey"))
    got = dense_key(flaky_input, order, "id", partitions=4)
    ref = li.select(F.row_number().over(Window.orderBy(*order)).cast("bigint").alias("id"), *li.columns)
    diff = got.select(ref.columns).exceptAll(ref).count() + ref.exceptAll(got.select(ref.columns)).count()
    tracker = spark.sparkContext.statusTracker()
    failed = 0
    for sid in range(0, 400):
        info = tracker.getStageInfo(sid)
        if info is not None:
            failed += info.numFailedTasks
    print("RESULT", got.count(), ref.count(), diff, failed)
""")


def test_dense_key_survives_a_failed_task(tmp_path):
    script = tmp_path / "retry.py"
    script.write_text(SCRIPT.format(repo=REPO))
    out = subprocess.run([sys.executable, str(script)], capture_output=True, text=True, timeout=600)
    line = [x for x in out.stdout.splitlines() if x.startswith("RESULT")]
    assert line, out.stderr[-2000:]
    _, got, ref, diff, failed = line[0].split()
    assert int(failed) >= 1  # the failure did happen and was retried
    assert got == ref and diff == "0"
