"""python -m bibspark.plans.cli --input FOLDER --output FOLDER"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from bibspark.plans.pipeline import Pipeline


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="bibspark", description="Prepare bibliographic exports")
    p.add_argument("--input", "-i", required=True)
    p.add_argument("--output", "-o", required=True)
    p.add_argument("--title-threshold", type=float, default=90.0)
    p.add_argument("--author-threshold", type=float, default=85.0)
    p.add_argument("--validate-mapping", action="store_true")
    p.add_argument("--file-count", type=int, default=0, help="how many files the folder must hold")
    p.add_argument("--one-database", action="store_true", help="refuse files of different databases")
    p.add_argument("--log-folder", help="local folder for log files")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("bibspark").getOrCreate()
    s = Pipeline(spark, a.title_threshold, a.author_threshold, a.validate_mapping, a.file_count, a.one_database, a.log_folder).run(a.input, a.output)
    print(json.dumps({"counts": s.counts, "quality": s.quality, "errors": s.errors}, default=str))
    return int(bool(s.errors))


if __name__ == "__main__":
    sys.exit(main())
