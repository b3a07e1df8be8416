"""Run everything: ``spark-submit`` this file or ``python -m tidelane RAW_PATH OUTPUT_ROOT``."""

from __future__ import annotations

import argparse

from tidelane.plans.batch import run
from tidelane.plans.session import session


def main() -> None:
    parser = argparse.ArgumentParser(description="order-line files to star schema, results and report tables")
    parser.add_argument("raw", help="CSV file or folder of order lines")
    parser.add_argument("root", help="folder for the tables")
    parser.add_argument("--snapshot", help="Parquet folder of counted stock: product_id, current_stock_units")
    parser.add_argument(
        "--multiline", action="store_true", help="allow line breaks inside quotes, at the price of a shuffle of the text"
    )
    parser.add_argument("--append", action="store_true", help="add the lines to the last load instead of replacing it")
    args = parser.parse_args()
    spark = session()
    snapshot = spark.read.parquet(args.snapshot) if args.snapshot else None
    run(spark, args.raw, args.root, inventory_snapshot=snapshot, multiline=args.multiline, append=args.append)
    spark.stop()


if __name__ == "__main__":
    main()
