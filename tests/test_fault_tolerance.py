"""Lost work is recomputed: failed task attempts are retried from lineage with the same result.

Runs in a subprocess because retries in local mode need a ``local[N,F]`` master.
"""

import os
import subprocess
import sys
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = textwrap.dedent("""
    import sys
    sys.path.insert(0, sys.argv[1]); sys.path.insert(0, sys.argv[1] + "/tests")
    from pyspark import TaskContext
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master("local[4,4]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "4").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    from fixtures import platform_tables
    from test_reports import PLATFORM
    from spendlens.plans import platform_report
    from spendlens.sources import loader

    def flaky(batches):
        # the first attempt of every task reading the fact fails after reading its input
        for batch in batches:
            if TaskContext.get().attemptNumber() == 0:
                raise RuntimeError("injected task failure")
            yield batch

    clean = platform_tables(spark)
    hurt = dict(clean)
    fact = clean["platform_report"].repartition(3)
    hurt["platform_report"] = fact.mapInPandas(flaky, fact.schema)
    a = sorted(map(str, platform_report(PLATFORM, loader(spark, "", clean)).collect()))
    b = sorted(map(str, platform_report(PLATFORM, loader(spark, "", hurt)).collect()))
    print("EQUAL" if a == b and a else "DIFFERENT")
""")


def test_report_survives_failed_task_attempts(tmp_path):
    script = tmp_path / "flaky.py"
    script.write_text(SCRIPT)
    out = subprocess.run([sys.executable, str(script), ROOT], capture_output=True, text=True,
                         timeout=600)
    assert "EQUAL" in out.stdout, out.stdout[-2000:] + out.stderr[-2000:]
