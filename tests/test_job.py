import glob
import os
import tempfile

from conftest import SF001

from markbook.plans import job, portfolio_daily
from markbook.sources import standin


def test_daily_job_writes_one_report_per_user(spark):
    t = standin.load(spark, SF001)
    p = standin.standin_params(user=None, users=("A", "R"))
    out = tempfile.mkdtemp(prefix="markbook-job-") + "/daily"
    job.run(spark, t, p, "daily", out)
    dirs = sorted(os.path.basename(d) for d in glob.glob(out + "/_user=*"))
    assert dirs == ["_user=A", "_user=R"]
    back = spark.read.option("header", True).csv(out + "/_user=R")
    single = portfolio_daily(spark, t, standin.standin_params())
    assert back.count() == single.count() == 151
    tot = back.where("ticker = 'TOTAL'").collect()[0]
    exp = single.where("ticker = 'TOTAL'").collect()[0]
    assert int(tot["market_value"]) == exp["market_value"]


def test_unquoted_csv_like_psql(spark):
    from markbook.sources.sinks import write_csv
    df = spark.createDataFrame([("a,b", 1)], "d string, n int")
    out = tempfile.mkdtemp(prefix="markbook-csv-") + "/x"
    write_csv(df, out, single_file=True, unquoted=True)
    text = open(glob.glob(out + "/part-*")[0]).read().splitlines()
    assert text == ["d,n", "a,b,1"]
    write_csv(df, out, single_file=True)
    text = open(glob.glob(out + "/part-*.csv")[0]).read().splitlines()
    assert text == ["d,n", '"a,b",1']
