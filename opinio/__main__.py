"""Command line entry points (submit with ``spark-submit -m``-style launchers or ``python -m opinio``).

    python -m opinio clean      --input reviews.csv --output out/cleaned_data [--schema "user_id INT, ..."]
    python -m opinio sentiment  --input out/cleaned_data --output out/sentiment_results
    python -m opinio recommend  --input out/cleaned_data --output out/recommendations
    python -m opinio report     --cleaned out/cleaned_data --sentiment out/sentiment_results --output out/reports
    python -m opinio universal  --input any.csv --output-root out [--collections out/db] [--real-ids] [--schema ...]
    python -m opinio summary    --pointer out/latest_run
    python -m opinio serving    --collections out/db

Every command builds the session from the environment (``spark-submit``
settings win), runs one job and writes with the executors; ``clean``,
``sentiment`` and ``recommend`` also write their statistics as small tables under
``<output>_stats``.  ``summary`` and ``serving`` show a small frame.  Scratch tables
are deleted at the end.
"""

from __future__ import annotations

import argparse
import time

from pyspark.sql import DataFrame, SparkSession

from opinio.operators import clean, recommend, reports
from opinio.plans import jobs
from opinio.session import clear_scratch
from opinio.sources import files


def _session() -> SparkSession:
    return SparkSession.builder.appName("opinio").getOrCreate()


def _write_tables(tables: dict[str, DataFrame], base: str) -> None:
    for name, df in tables.items():
        files.write_parquet(df, f"{base}/{name}")


def _clean(spark: SparkSession, args) -> None:
    out = clean.clean_with_counts(files.read_csv(spark, args.input, args.schema))
    files.write_parquet(out.cleaned, args.output)
    stats = {"cleaning_funnel": out.funnel, "duplicate_stats": out.duplicates, "missing_counts": out.missing,
             "rating_counts": reports.rating_counts(files.read_parquet(spark, args.output))}
    _write_tables(stats, f"{args.output}_stats")


def _sentiment(spark: SparkSession, args) -> None:
    files.write_parquet(jobs.batch_sentiment(files.read_parquet(spark, args.input)), args.output)
    labelled = files.read_parquet(spark, args.output)
    stats = {"sentiment_counts": reports.sentiment_counts(labelled), "sentiment_by_rating": reports.sentiment_by_rating(labelled),
             "confidence_by_sentiment": reports.confidence_by_sentiment(labelled)}
    _write_tables(stats, f"{args.output}_stats")


def _recommend(spark: SparkSession, args) -> None:
    cleaned = files.read_parquet(spark, args.input)
    out = jobs.batch_recommend(cleaned)
    jobs.save_batch_recommendations(out, args.output)
    stats = {"distinct_counts": reports.distinct_counts(cleaned), "split_counts": recommend.split_counts(out.train, out.test),
             "rmse": out.rmse, "avg_predicted_by_user": out.avg_predicted_by_user, "top_recommended": out.top_recommended}
    _write_tables(stats, f"{args.output}_stats")


def _show(frame: DataFrame | None, otherwise: str) -> int:
    if frame is None:
        print(otherwise)
        return 1
    frame.show(1000, truncate=False)
    return 0


def _collection(spark: SparkSession, path: str) -> DataFrame | None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
    return files.read_parquet(spark, path) if there else None


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="opinio")
    sub = p.add_subparsers(dest="cmd", required=True)
    for name in ("clean", "sentiment", "recommend"):
        s = sub.add_parser(name)
        s.add_argument("--input", required=True)
        s.add_argument("--output", required=True)
        if name == "clean":
            s.add_argument("--schema", help="column definitions of the CSV; without it types are inferred by an extra pass")
    r = sub.add_parser("report")
    for option in ("--cleaned", "--sentiment", "--output"):
        r.add_argument(option, required=True)
    u = sub.add_parser("universal")
    u.add_argument("--input", required=True)
    u.add_argument("--output-root", required=True)
    u.add_argument("--collections")
    u.add_argument("--real-ids", action="store_true")
    u.add_argument("--schema")
    m = sub.add_parser("summary")
    m.add_argument("--pointer", required=True)
    v = sub.add_parser("serving")
    v.add_argument("--collections", required=True)
    args = p.parse_args(argv)

    spark = _session()
    try:
        if args.cmd in ("clean", "sentiment", "recommend"):
            {"clean": _clean, "sentiment": _sentiment, "recommend": _recommend}[args.cmd](spark, args)
        elif args.cmd == "report":
            pack = jobs.report_pack(files.read_parquet(spark, args.cleaned), files.read_parquet(spark, args.sentiment))
            _write_tables(pack, args.output)
        elif args.cmd == "universal":
            root = args.output_root.rstrip("/")
            raw = files.read_csv_multiline(spark, args.input, args.schema)
            jobs.universal_run(spark, raw, f"{root}/run_{int(time.time())}", f"{root}/latest_run",
                               collections_base=args.collections, real_ids=args.real_ids)
        elif args.cmd == "summary":
            return _show(jobs.results_summary(spark, args.pointer), "no published run")
        elif args.cmd == "serving":
            found = [_collection(spark, f"{args.collections}/{name}") for name in ("sentiment_analysis", "recommendations")]
            return _show(jobs.serving_summary(*found), "no collections")
        return 0
    finally:
        clear_scratch(spark)


if __name__ == "__main__":
    raise SystemExit(main())
