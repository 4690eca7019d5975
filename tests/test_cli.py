from __future__ import annotations

import json

import pytest

from plaudit.cli import main, parser
from plaudit.sources.lake import write_csv


@pytest.fixture(scope="module")
def csv(many_reviews, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("cli") / "reviews")
    write_csv(many_reviews(309), path)
    return path


def test_check_gives_an_exit_code(spark, csv, tmp_path, capsys):
    assert main(["check", "--source", csv, "--report", str(tmp_path / "report")]) == 0
    assert spark.read.json(str(tmp_path / "report")).count() == 6
    strict = tmp_path / "strict.json"
    strict.write_text(json.dumps({"suite": "strict", "checks": [
        {"name": "always_five", "type": "between", "column": "rating", "min": 5, "max": 5}]}))
    assert main(["check", "--source", csv, "--suite", str(strict)]) == 1
    assert "FAIL  always_five" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        main(["check"])


def test_lake_jobs(spark, csv, tmp_path, capsys):
    lake = str(tmp_path / "lake")
    assert main(["land", "--source", csv, "--lake", lake]) == 0
    assert main(["silver", "--lake", lake]) == 0
    assert "309 rows from 309" in capsys.readouterr().out
    assert main(["check", "--lake", lake]) == 0
    assert main(["gold", "--lake", lake]) == 0
    assert main(["warehouse", "--lake", lake, "--warehouse", str(tmp_path / "wh"), "--load", "l1"]) == 0
    assert "l1: 309 facts" in capsys.readouterr().out


def test_detect(spark, csv, tmp_path):
    assert main(["detect", "--source", csv, "--out", str(tmp_path / "flagged")]) == 0
    flagged = spark.read.option("header", True).csv(str(tmp_path / "flagged"))
    assert 0 < flagged.count() < 309 and "is_suspicious" in flagged.columns


def test_index(spark, csv, tmp_path):
    first, second = str(tmp_path / "one"), str(tmp_path / "two")
    assert main(["index", "--source", csv, "--out", first]) == 0
    assert main(["index", "--source", csv, "--out", second, "--previous", first, "--no-vector"]) == 0
    assert spark.read.parquet(second).count() == 309
    assert spark.read.parquet(second).filter("embedding is not null").count() == 0


def test_stream_options():
    args = parser().parse_args(["stream", "--servers", "b:1", "--checkpoint", "c"])
    assert (args.topic, args.scored, args.starting) == ("reviews.raw", "reviews.scored", "latest")


def test_similar(spark, csv, tmp_path):
    out = str(tmp_path / "similar")
    assert main(["similar", "--source", csv, "--wanted", csv, "--out", out, "--k", "2", "--exact"]) == 0
    found = spark.read.option("header", True).csv(out)
    assert found.columns == ["query_id", "review_id", "score", "rank"] and found.count() == 2 * 309
