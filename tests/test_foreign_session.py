"""Registered queries run on a session made elsewhere: other time zone, default partitions, any cwd."""
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = r"""
import sys
sys.path.insert(0, %r)
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "America/New_York").getOrCreate())
import __spark_entry__ as E
q = E.queries()
print("RESULT", E.entry(spark).count(), q["bars_1h"](spark, "/root/testdata/sf0.001").count(),
      q["stream_ema"](spark, "/root/testdata/sf0.001").count())
""" % ROOT


def test_foreign_session(tmp_path):
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, capture_output=True, text=True, timeout=900)
    line = [l for l in out.stdout.splitlines() if l.startswith("RESULT")]
    assert line, out.stderr[-3000:]
    _, adv, bars, ema = line[0].split()
    assert int(bars) == 960 and int(ema) == 959 and int(adv) > 0
