"""Batch entry points (spark-submit friendly).

    python -m fundlens.cli build-mart   --sf DIR --out DIR    # 14 mart tables (S6) + views (S7)
    python -m fundlens.cli check        --sf DIR              # quality gate (D11); exit 1 on FAIL
    python -m fundlens.cli api-snapshot --sf DIR --out DIR    # star schema tables (X12)
    python -m fundlens.cli payload      --sf DIR --out DIR    # dashboard payload as JSON lines (X14)
    python -m fundlens.cli fx-refresh   --payloads DIR --table DIR [--stale-max-days N]

``--sf`` points at the driver's parquet tables (read through the adapter).
With ``--source-dir`` instead, the twelve fund source tables are read as
``DIR/<name>`` parquet folders. Each build of ``build-mart`` and
``api-snapshot`` is a new version of its output folder (``sources/publish.py``);
the payload folder is overwritten.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import config
from .session import ensure_checkpoint_dir, get_spark


def _source(spark: SparkSession, args) -> object:
    if args.source_dir:
        from .sources.testdata import SOURCE_VIEWS

        return {v: spark.read.parquet(f"{args.source_dir.rstrip('/')}/{v}") for v in SOURCE_VIEWS}
    from .sources.testdata import TestData

    return TestData(spark, args.sf, materialize=True)


def _mart(spark: SparkSession, args):
    from .plans.mart import Mart

    return Mart(spark, _source(spark, args), base_ccy=args.base_ccy, top_n=args.top_n)


def cmd_build_mart(spark: SparkSession, args) -> int:
    from .sources.publish import publish

    m = _mart(spark, args)
    tables = m.tables()
    version = publish(tables, args.out)
    m.register_views()
    print(f"published {len(tables)} tables under {args.out} as version {version}")
    return 0


def cmd_check(spark: SparkSession, args) -> int:
    from .operators.quality import overall, report

    rep = report(_mart(spark, args), args.fx_missing_max_pct)
    rep.show(truncate=False)
    res = overall(rep).first()
    print(f"RESULT: {res['result']}")
    return 0 if res["result"] == "PASS" else 1


def cmd_api_snapshot(spark: SparkSession, args) -> int:
    from .plans.star import StarSchema
    from .sources.publish import publish, published

    star = StarSchema(_mart(spark, args), known=published(spark, args.out))  # ids of earlier snapshots are kept
    version = publish({**star.tables(), **star.key_tables()}, args.out)
    print(f"published the snapshot under {args.out} as version {version}")
    return 0


def cmd_payload(spark: SparkSession, args) -> int:
    from .plans.serving import payload_sections, write_payload

    write_payload(payload_sections(_mart(spark, args)), args.out)
    return 0


def cmd_fx_refresh(spark: SparkSession, args) -> int:
    from .plans.fx_refresh import staleness
    from .streaming.fx_stream import start_fx_payload_stream

    q = start_fx_payload_stream(spark, args.payloads, args.table, args.checkpoint or args.table + "_stream_ckpt",
                                args.symbols)
    q.awaitTermination()
    fx = spark.read.parquet(args.table)
    as_of = spark.range(1).select(F.current_date().alias("as_of"))
    st: DataFrame = staleness(fx, as_of, args.stale_max_days)
    row = st.first()
    print(f"FX latest={row['latest_date_rate']} age_days={row['age_days']} status={row['status']}")
    return 0 if row["status"] == "PASS" else 1


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="fundlens")
    sub = ap.add_subparsers(dest="cmd", required=True)
    for name in ("build-mart", "check", "api-snapshot", "payload"):
        p = sub.add_parser(name)
        p.add_argument("--sf", default="/root/testdata/sf0.01")
        p.add_argument("--source-dir", default=None)
        p.add_argument("--base-ccy", default=config.BASE_CCY)
        p.add_argument("--top-n", type=int, default=config.TOP_N)
        p.add_argument("--fx-missing-max-pct", type=float, default=config.FX_MISSING_MAX_PCT)
        if name != "check":
            p.add_argument("--out", required=True)
    p = sub.add_parser("fx-refresh")
    p.add_argument("--payloads", required=True)
    p.add_argument("--table", required=True)
    p.add_argument("--checkpoint", default=None)
    p.add_argument("--symbols", default=config.FX_DEFAULT_SYMBOLS)
    p.add_argument("--stale-max-days", type=int, default=config.FX_STALE_MAX_DAYS)
    args = ap.parse_args(argv)
    spark = get_spark()
    ensure_checkpoint_dir(spark)
    handlers = {
        "build-mart": cmd_build_mart,
        "check": cmd_check,
        "api-snapshot": cmd_api_snapshot,
        "payload": cmd_payload,
        "fx-refresh": cmd_fx_refresh,
    }
    return handlers[args.cmd](spark, args)


if __name__ == "__main__":
    sys.exit(main())
