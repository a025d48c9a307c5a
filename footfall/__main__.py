"""``python -m footfall check|clean|add|analyse|export SOURCE TARGET [NAME ...]``"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from footfall import jobs
from footfall.params import BUSINESS_ZONE, RANGE_END, RANGE_START
from footfall.sources import load_clean, read_log


def options(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="footfall", description=__doc__)
    parser.add_argument("job", choices=("check", "clean", "add", "analyse", "export"))
    parser.add_argument("source", help="raw CSV log to check, clean or add, else the cleaned log")
    parser.add_argument("target", help="folder to write")
    parser.add_argument("names", nargs="*", help="analyses to run, all if none is given")
    parser.add_argument("--start", type=int, default=RANGE_START, help="first epoch second to keep")
    parser.add_argument("--end", type=int, default=RANGE_END, help="last epoch second to keep")
    parser.add_argument("--zone", default=BUSINESS_ZONE, help="zone of dates and hours")
    parser.add_argument("--only-days", action="store_true", help="other days stay as stored")
    parser.add_argument("--clustered", action="store_true", help="files by date, user and time")
    parser.add_argument("--validate", action="store_true", help="check the log before analyses")
    parser.add_argument("--cache", action="store_true", help="keep the log for all analyses")
    return parser.parse_args(arguments)


def main(arguments: list[str] | None = None) -> None:
    chosen = options(arguments)
    spark = SparkSession.builder.appName(f"footfall-{chosen.job}").getOrCreate()
    limits = (chosen.start, chosen.end)
    if chosen.job == "check":
        jobs.check(read_log(spark, chosen.source), chosen.target, *limits)
    elif chosen.job == "clean":
        counts = jobs.clean_log(
            spark, chosen.source, chosen.target, *limits, chosen.zone, chosen.only_days,
            chosen.clustered,
        )
        print(*(f"{name} {count}" for name, count in counts.items()), sep="\n")
    elif chosen.job == "add":
        jobs.add_batch(spark, chosen.source, chosen.target, *limits, chosen.zone)
    else:
        log = load_clean(spark, chosen.source, cache=chosen.cache)
        if chosen.job == "analyse":
            validate = limits if chosen.validate else None
            jobs.analyse(log, chosen.target, chosen.names or None, validate)
        else:
            jobs.export(log, chosen.target)


if __name__ == "__main__":
    main()
