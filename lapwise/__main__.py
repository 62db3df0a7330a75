"""`python -m lapwise build|report|train|score`: the whole work over landed tables."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from lapwise.ml.score import score
from lapwise.ml.train import load_model, save_model
from lapwise.session import drop_staged
from lapwise.plans.build import LAYOUT, build, reports
from lapwise.plans.training import train_classified_position, train_position, train_winner
from lapwise.sources.reports import write_report
from lapwise.sources.tables import write_table

IDS = ("RACEYEAR", "RACENUMBER", "DriverId")
ORDER = ("RACEYEAR", "RACENUMBER", "DriverNumber")
TRAINERS = {
    "winner": ("before_race", train_winner),
    "position": ("before_race", train_position),
    "classified": ("full", train_classified_position),
}


def main() -> None:
    parser = argparse.ArgumentParser(prog="lapwise")
    commands = parser.add_subparsers(dest="command", required=True)
    one = commands.add_parser("build", help="session tables and datasets from landed tables")
    one.add_argument("root")
    one.add_argument("out")
    one.add_argument("--format", default="csv")
    one.add_argument("--layout", default=LAYOUT)
    one.add_argument("--rerun", action="store_true", help="replace only the sessions that have landed")
    two = commands.add_parser("report", help="report tables from built datasets")
    two.add_argument("out")
    two.add_argument("--wide", action="store_true", help="a column for each driver, team and location")
    three = commands.add_parser("train", help="search, fit and evaluate a model")
    three.add_argument("out")
    three.add_argument("model", choices=TRAINERS)
    three.add_argument("--draws", type=int)
    three.add_argument("--folds", type=int, default=5)
    three.add_argument("--fill-within-race", action="store_true", help="fill missing inputs from the same race only")
    four = commands.add_parser("score", help="win probability of new rows")
    four.add_argument("out")
    four.add_argument("rows")
    four.add_argument("--format", default="parquet")
    options = parser.parse_args()
    spark = SparkSession.builder.appName("lapwise").getOrCreate()

    if options.command == "build":
        build(spark, options.root, options.out, options.format, options.layout, rerun=options.rerun)
    elif options.command == "report":
        for name, table in reports(spark.read.parquet(f"{options.out}/full"), options.wide).items():
            write_table(table, f"{options.out}/reports/{name}")
    elif options.command == "train":
        source, trainer = TRAINERS[options.model]
        extra = {"draws": options.draws} if options.draws else {}
        trained = trainer(spark.read.parquet(f"{options.out}/{source}"), IDS, ORDER, folds=options.folds,
                          whole_frame=not options.fill_within_race, **extra)
        save_model(trained.model, f"{options.out}/models/{options.model}")
        write_report(trained.metrics, f"{options.out}/models/{options.model}_metrics")
        write_table(trained.importance, f"{options.out}/models/{options.model}_importance")
    else:
        reader = spark.read.option("header", True).option("inferSchema", True) if options.format == "csv" else spark.read
        rows = reader.format(options.format).load(options.rows)
        write_table(score(rows, load_model(f"{options.out}/models/winner")), f"{options.out}/scored")
    drop_staged(spark)


if __name__ == "__main__":
    main()
