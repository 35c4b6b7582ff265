"""The command line runs jobs and registered queries."""

import json

from fixtures import SALES_HEADER, SALES_ROWS, write_text
from tidewater.__main__ import main


def test_cli_query_to_parquet(spark, tmp, capsys):
    main(["query", "--name", "sales_by_payment", "--tables", "/root/testdata/sf0.001", "--out", f"{tmp}/q"])
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == {"written": f"{tmp}/q"}
    assert spark.read.parquet(f"{tmp}/q").count() == 2


def test_cli_sales_job(spark, tmp, capsys):
    raw = write_text(f"{tmp}/raw/s.csv", [SALES_HEADER, *SALES_ROWS])
    main(["sales", "--raw", raw, "--out", f"{tmp}/lake"])
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == {"raw_rows": 10, "clean_rows": 10, "rejected_rows": 0}
