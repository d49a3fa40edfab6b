"""One inspection run: ``python -m linecheck <settings file>``."""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

from linecheck.plans.inspection import read_settings, run_inspection
from linecheck.session import SETTINGS


def main(path: str) -> None:
    builder = SparkSession.builder.appName("linecheck")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    outcome = run_inspection(spark, read_settings(spark, path))
    print("nothing new" if outcome.upto is None else f"done up to {outcome.upto}")


if __name__ == "__main__":
    if len(sys.argv) != 2:
        sys.exit("usage: python -m linecheck <settings file>")
    main(sys.argv[1])
