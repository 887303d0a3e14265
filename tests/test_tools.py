"""The plan summary tool reads shuffles, broadcasts, reuse and pushed filters."""

import os
import sys

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from plan_report import summarize  # noqa: E402


def test_plan_summary(spark):
    lineitem = "/root/testdata/sf0.01/lineitem.parquet"
    df = (spark.read.parquet(lineitem).where("l_partkey = 7")
          .groupBy("l_returnflag").count())
    df._jdf.queryExecution().toRdd().count()
    s = summarize(df._jdf.queryExecution().executedPlan().toString())
    assert s["shuffles"] >= 1 and s["scans"] == ["lineitem"]
    assert any("EqualTo(l_partkey,7)" in p for p in s["pushed"])
