"""Run the whole flow: ``python -m filmlake FILMS GENRES SILVER GOLD``."""

from __future__ import annotations

import argparse
import sys

from filmlake.plans.contracts import contract_report
from filmlake.plans.pipeline import build_gold, build_silver, read_silver
from filmlake.session import get_spark
from filmlake.sources import FILM_FILES


def main() -> None:
    parser = argparse.ArgumentParser(prog="filmlake", description="Bronze JSON to silver and gold.")
    parser.add_argument("films", help="folder of JSON-lines files")
    parser.add_argument("genres", help="JSON array of genres")
    parser.add_argument("silver", help="folder for the Parquet tables")
    parser.add_argument("gold", help="folder for the CSV results")
    parser.add_argument("--pattern", default=FILM_FILES, help="names of the film files")
    parser.add_argument("--as-of", help="day that counts as today, yyyy-mm-dd")
    parser.add_argument("--input-gb", type=float, help="size of the input, to size the shuffles")
    options = parser.parse_args()

    size = None if options.input_gb is None else int(options.input_gb * 1024**3)
    spark = get_spark(input_bytes=size)
    report = build_silver(
        spark, options.films, options.genres, options.silver, options.as_of, options.pattern
    )
    failed = 0
    for name, value in report.items():
        print(f"{name}: {value}")
    if report["films"]:
        contract_report(read_silver(spark, options.silver)).show(truncate=False)
        status = build_gold(spark, options.silver, options.gold)
        status.show(truncate=False)
        failed = status.filter("NOT ok").count()
    spark.stop()
    if failed:
        sys.exit(1)


if __name__ == "__main__":
    main()
