"""The command line runs the batch chain and the universal run on CSV written from the fixture."""

from opinio import __main__ as cli
from opinio.plans import queries
from opinio.sources import files
from tests.conftest import SF_SMALL


def test_cli_commands(spark, capsys, tmp_path):
    base = str(tmp_path)
    csv = f"{base}/reviews_csv"
    files.write_csv(queries.raw(spark, SF_SMALL), csv, multiline=True)
    assert cli.main(["clean", "--input", csv, "--output", f"{base}/cleaned"]) == 0
    assert cli.main(["sentiment", "--input", f"{base}/cleaned", "--output", f"{base}/sentiment"]) == 0
    cleaned = spark.read.parquet(f"{base}/cleaned")
    assert cleaned.count() == queries.cleaned(spark, SF_SMALL).count()
    assert "sentiment" in spark.read.parquet(f"{base}/sentiment").columns
    assert spark.read.parquet(f"{base}/cleaned_stats/cleaning_funnel").count() == 6
    assert spark.read.parquet(f"{base}/sentiment_stats/sentiment_by_rating").count() > 1
    assert cli.main(["recommend", "--input", f"{base}/cleaned", "--output", f"{base}/recs"]) == 0
    parts = {r.part: r.records for r in spark.read.parquet(f"{base}/recs_stats/split_counts").collect()}
    assert parts["train"] + parts["test"] == cleaned.count()
    assert spark.read.parquet(f"{base}/recs_stats/rmse").first()["rmse"] > 0
    assert cli.main(["report", "--cleaned", f"{base}/cleaned", "--sentiment", f"{base}/sentiment", "--output", f"{base}/reports"]) == 0
    assert spark.read.parquet(f"{base}/reports/top_products").count() == 10
    schema = queries.raw(spark, SF_SMALL).schema.simpleString()[7:-1].replace(":", " ")
    assert cli.main(["clean", "--input", csv, "--output", f"{base}/cleaned2", "--schema", schema]) == 0
    assert cli.main(["universal", "--input", csv, "--output-root", f"{base}/runs", "--collections", f"{base}/db"]) == 0
    assert cli.main(["summary", "--pointer", f"{base}/runs/latest_run"]) == 0
    assert "total_records" in capsys.readouterr().out
    assert cli.main(["serving", "--collections", f"{base}/db"]) == 0
    assert "recommendations_preview" in capsys.readouterr().out
    assert cli.main(["serving", "--collections", f"{base}/none"]) == cli.main(["summary", "--pointer", f"{base}/none"]) == 1
