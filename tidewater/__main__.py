"""Command line for the end-to-end jobs.

    python -m tidewater sales   --raw data/sales/ --out lake/sales
    python -m tidewater sales-stream --raw data/sales/ --out lake/sales --checkpoint <shared>/ck/sales
    python -m tidewater orders  --raw landing/orders/ --out lake/orders
    python -m tidewater orders-incremental --raw landing/orders/ --store tables/orders --checkpoint <shared>/ck/orders
    python -m tidewater fraud-features --raw tx/ --features feat/ --out lake/features --run-date 2024-01-15
    python -m tidewater scores  --raw bucket/ --out tables/student_scores
    python -m tidewater incidents --raw incidents/ --store store/ --logs logs/ --outbox outbox/
    python -m tidewater reports --raw reports/ --audit tables/reports --outbox outbox/
    python -m tidewater query   --name sales_revenue_by_store --tables /root/testdata/sf0.01 [--out path]

The session comes from ``spark-submit`` / the cluster defaults; settings the
results depend on (UTC, string partition values) are applied on top.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from .session import build_session


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="tidewater")
    sub = ap.add_subparsers(dest="cmd", required=True)
    for name, args in {
        "sales": ["raw", "out"],
        "sales-stream": ["raw", "out", "checkpoint"],
        "orders": ["raw", "out"],
        "orders-incremental": ["raw", "store", "checkpoint"],
        "fraud-features": ["raw", "features", "out", "run-date"],
        "scores": ["raw", "out"],
        "incidents": ["raw", "store", "logs", "outbox"],
        "reports": ["raw", "audit", "outbox"],
        "query": ["name", "tables", "out?"],
    }.items():
        p = sub.add_parser(name)
        for a in args:
            p.add_argument(f"--{a.rstrip('?')}", required=not a.endswith("?"))
        p.add_argument("--profile", choices=["default", "cluster"], default="default", help="sizing where the cluster sets none")
        p.add_argument("--errors", help="dead-letter path (default: beside the output)")
    ns = ap.parse_args(argv)
    spark = build_session(app_name=f"tidewater-{ns.cmd}", profile=ns.profile)
    from .plans import runners as J
    if ns.cmd == "sales":
        result = J.run_sales(spark, ns.raw, ns.out, ns.errors)
    elif ns.cmd == "sales-stream":
        result = J.run_sales_stream(spark, ns.raw, ns.out, ns.checkpoint, ns.errors)
    elif ns.cmd == "orders":
        result = J.run_orders_etl(spark, ns.raw, ns.out, ns.errors)
    elif ns.cmd == "orders-incremental":
        result = J.run_orders_incremental(spark, ns.raw, ns.store, ns.checkpoint, errors_path=ns.errors)
    elif ns.cmd == "fraud-features":
        result = J.run_fraud_features(spark, ns.raw, ns.features, ns.out, dt.date.fromisoformat(ns.run_date), ns.errors)
    elif ns.cmd == "scores":
        J.run_scores(spark, ns.raw, ns.out, ns.errors)
        result = {"table": ns.out}
    elif ns.cmd == "incidents":
        result = J.run_incidents(spark, ns.raw, ns.store, ns.logs, ns.outbox, ns.errors)
    elif ns.cmd == "reports":
        result = J.run_reports(spark, ns.raw, ns.audit, ns.outbox).first().asDict()
    else:
        from .plans import load_all
        qs, _ = load_all()
        df = qs[ns.name](spark, ns.tables)
        if ns.out:
            df.write.mode("overwrite").parquet(ns.out)
            result = {"written": ns.out}
        else:
            df.show(20, truncate=False)
            result = {"query": ns.name}
    print(json.dumps(result, default=str))


if __name__ == "__main__":
    main()
