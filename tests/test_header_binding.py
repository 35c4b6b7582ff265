"""CSV columns go by each file's header."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from fixtures import SALES_HEADER, SALES_ROWS, write_text
from tidewater.plans import runners as J
from tidewater.sinks import lake
from tidewater.sources import files

SCHEMA = "id STRING, n INT, day STRING"


def rows(df):
    return sorted((tuple(r) for r in df.select("id", "n", "day", files.CORRUPT).collect()), key=str)


def test_reordered_renamed_missing_and_extra_columns(spark, tmp):
    write_text(f"{tmp}/a.csv", ["id,n,day", "a,1,mon"])
    write_text(f"{tmp}/b.csv", [" Day ,ID,N", "tue,b,2"])
    write_text(f"{tmp}/c.csv", ["n,extra,id", "3,x,c"])
    write_text(f"{tmp}/d.csv", ['﻿N,"Day","Id"', "4,\"w,ed\",d"])
    write_text(f"{tmp}/e.csv", [])
    with gzip.open(f"{tmp}/f.csv.gz", "wt") as f:
        f.write("day,n,id\nfri,6,f\n")
    got = rows(files.read_csv(spark, tmp, SCHEMA))
    assert got == [("a", 1, "mon", None), ("b", 2, "tue", None), ("c", 3, None, None), ("d", 4, "w,ed", None), ("f", 6, "fri", None)]


def test_headers_that_tell_nothing_keep_every_line(spark, tmp):
    write_text(f"{tmp}/twice.csv", ["id,ID,n", "a,b,1"])
    write_text(f"{tmp}/none.csv", ["x1,7,mon", "x2,8,tue"])
    write_text(f"{tmp}/good.csv", ["id,n,day", "g,1,mon", "bad,line"])
    got = rows(files.read_csv(spark, tmp, SCHEMA))
    assert [r[3] for r in got if r[0] is None] == ["a,b,1", "id,ID,n", "x1,7,mon", "x2,8,tue"]
    assert [r[:3] for r in got if r[0] is not None and r[3] is None] == [("g", 1, "mon")]
    assert [r[3] for r in got if r[0] == "bad"] == ["bad,line"]


def test_one_scan_per_header_and_paths(spark, tmp):
    for k in range(6):
        write_text(f"{tmp}/{k}.csv", ["id,n,day" if k % 2 else "day,id,n", f"a{k},{k},x" if k % 2 else f"x,a{k},{k}"])
    df = files.read_csv(spark, tmp, SCHEMA, path_col="path", block_col="block")
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 2
    got = {r.id: (r.n, os.path.basename(r.path), r.block) for r in df.collect()}
    assert got == {f"a{k}": (k, f"{k}.csv", 0) for k in range(6)}
    assert files.read_csv(spark, [f"{tmp}/1.csv"], SCHEMA).count() == 1


def test_empty_folder(spark, tmp):
    os.makedirs(f"{tmp}/none")
    df = files.read_csv(spark, f"{tmp}/none", SCHEMA, path_col="path")
    assert df.columns == ["id", "n", "day", files.CORRUPT, "path"] and df.count() == 0


def test_sales_job_binds_by_name(spark, tmp):
    names = SALES_HEADER.split(",")
    order = list(reversed(range(len(names))))
    write_text(f"{tmp}/in/a.csv", [SALES_HEADER, *SALES_ROWS[:5]])
    swapped = [",".join(r.split(",")[k] for k in order) for r in SALES_ROWS[5:]]
    write_text(f"{tmp}/in/b.csv", [",".join(f" {names[k].replace('_', '-').title()} " for k in order), *swapped])
    assert J.run_sales(spark, f"{tmp}/in", f"{tmp}/lake") == {"raw_rows": 10, "clean_rows": 10, "rejected_rows": 0}
    whole = write_text(f"{tmp}/one.csv", [SALES_HEADER, *SALES_ROWS])
    J.run_sales(spark, whole, f"{tmp}/want")
    get = lambda p: sorted(map(str, lake.read_partitioned(spark, p).collect()))
    assert get(f"{tmp}/lake") == get(f"{tmp}/want")
    # a file without a required column: every row in the dead letter, none in another column
    cut = [",".join(v for k, v in enumerate(r.split(",")) if names[k] != "transaction_id") for r in [SALES_HEADER, *SALES_ROWS]]
    done = J.run_sales(spark, write_text(f"{tmp}/cut.csv", cut), f"{tmp}/lake2")
    assert done == {"raw_rows": 10, "clean_rows": 0, "rejected_rows": 10}
    assert {r.reason for r in spark.read.json(f"{tmp}/lake2-errors").collect()} == {"missing required value"}


def test_sales_stream_binds_by_name(spark, tmp):
    names = SALES_HEADER.split(",")
    write_text(f"{tmp}/in/a.csv", [SALES_HEADER, *SALES_ROWS[:5]])
    J.run_sales_stream(spark, f"{tmp}/in", f"{tmp}/lake", f"{tmp}/ck")
    write_text(f"{tmp}/in/b.csv", [",".join(reversed(names)), *[",".join(reversed(r.split(","))) for r in SALES_ROWS[5:]]])
    J.run_sales_stream(spark, f"{tmp}/in", f"{tmp}/lake", f"{tmp}/ck")
    back = lake.read_partitioned(spark, f"{tmp}/lake")
    assert back.count() == 10 and back.where(~F.col("transaction_id").startswith("TXN")).count() == 0


@pytest.mark.parametrize("header", [True, False])
def test_positions_where_there_is_no_header(spark, tmp, header):
    p = write_text(f"{tmp}/x.csv", ["id,n,day", "a,1,mon"])
    assert files.read_csv(spark, p, SCHEMA, header=header).count() == (1 if header else 2)
