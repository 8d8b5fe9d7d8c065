"""Command line: python -m parcelsight explore|clean|load|ask|export ..."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from parcelsight import jobs
from parcelsight.operators.profile import duplicate_rows, preview, profile
from parcelsight.plans import exploration
from parcelsight.plans.catalog import QUESTIONS
from parcelsight.plans.model import open_model, read_model
from parcelsight.session import sized_for, tune
from parcelsight.sources.files import read_csv, unreadable_cells, write_parquet
from parcelsight.sources.schemas import RAW_TYPES


def _print_rows(df: DataFrame) -> None:
    """Every row, tab-separated; rows come one partition at a time."""
    print("\t".join(df.columns))
    for row in df.toLocalIterator():
        print("\t".join("" if value is None else str(value) for value in row))


def _report(name: str, values: dict) -> None:
    for key, value in values.items():
        if isinstance(value, DataFrame):
            print(f"{name}: {key}")
            _print_rows(value)
        else:
            print(f"{name}: {key} = {value}")


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="parcelsight")
    parser.add_argument(
        "--shuffle-bytes", type=int, help="bytes the widest exchange moves; sets the partitions"
    )
    commands = parser.add_subparsers(dest="command", required=True)
    explore = commands.add_parser("explore", help="profile the raw tables")
    explore.add_argument("raw")
    explore.add_argument("tables", nargs="*", default=[], help=", ".join(RAW_TYPES))
    clean = commands.add_parser("clean", help="raw CSV to clean parquet")
    clean.add_argument("raw")
    clean.add_argument("clean")
    clean.add_argument("tables", nargs="*", default=[], help=", ".join(jobs.CLEANING))
    load = commands.add_parser("load", help="clean parquet to the checked model")
    load.add_argument("clean")
    load.add_argument("model")
    load.add_argument("--database", help="also keep the model as tables of this database")
    load.add_argument("--buckets", type=int, default=64, help="buckets of the tables by order")
    ask = commands.add_parser("ask", help="answer questions from the model")
    ask.add_argument("model", help="its folder, or with --database any word")
    ask.add_argument("--database", help="read the model from this database")
    ask.add_argument("--out", help="write each whole answer to a table in this folder")
    ask.add_argument("questions", nargs="*", default=[], help=", ".join(QUESTIONS))
    export = commands.add_parser("export", help="model to star tables")
    export.add_argument("model")
    export.add_argument("out")
    args = parser.parse_args(arguments)

    spark = SparkSession.builder.appName("parcelsight").getOrCreate()
    cores = spark.sparkContext.defaultParallelism
    tune(spark, sized_for(args.shuffle_bytes, cores) if args.shuffle_bytes else None)
    if args.command == "explore":
        tables = {}
        for table in args.tables or RAW_TYPES:
            path = f"{args.raw}/{table}.csv"
            df = tables[table] = read_csv(spark, path, table)
            parts = {"columns": profile(df), "duplicates": duplicate_rows(df), "rows": preview(df)}
            parts |= {"unreadable cells": unreadable_cells(spark, path, table)}
            _report(table, parts | exploration.summaries(table, df))
        if not args.tables:
            _report("tables", exploration.checks(tables))
    elif args.command == "clean":
        for table in args.tables or jobs.CLEANING:
            _report(table, jobs.CLEANING[table](spark, args.raw, args.clean))
    elif args.command == "load":
        stored = (args.database, args.buckets) if args.database else None
        _report("model", jobs.load_model(spark, args.clean, args.model, stored))
    elif args.command == "ask":
        model = open_model(spark, args.database) if args.database else read_model(spark, args.model)
        for question in args.questions or QUESTIONS:
            answer = QUESTIONS[question](model)
            if args.out:
                rows = write_parquet(answer, f"{args.out}/{question}")
                _report(question, {"rows": rows})
            else:
                print(question)
                _print_rows(answer)
    else:
        _report("star", jobs.export_star(spark, args.model, args.out))


if __name__ == "__main__":
    main()
