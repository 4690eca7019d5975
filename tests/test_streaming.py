from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from plaudit.streaming.jobs import compact_serving, file_messages, read_serving, start_scoring, start_serving
from plaudit.streaming.messages import parse_messages, score_messages, to_messages, unusable

NOW = {"availableNow": True}


@pytest.fixture
def inbox(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()

    def put(name, *lines):
        (folder / name).write_text("".join(
            (line if isinstance(line, str) else json.dumps(line)) + "\n" for line in lines))

    put.path = str(folder)
    return put


def run(spark, inbox, tmp_path):
    start_scoring(
        file_messages(spark, inbox.path), str(tmp_path / "ckpt"), sink="parquet",
        options={"path": str(tmp_path / "out")}, trigger=NOW, as_messages=False).awaitTermination()
    return sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect())


GOOD = {"review_id": "a", "category": "Books", "rating": 5, "review_text": "great and fast", "extra": [1]}


def test_scores_and_restarts_without_repeats(spark, inbox, tmp_path):
    inbox("1.json", GOOD, {"review_id": "b", "review_text": None})
    inbox("2.json")
    first = run(spark, inbox, tmp_path)
    assert first == [("a", "Books", 5, 5, "positive"), ("b", None, None, 3, "neutral")]
    assert run(spark, inbox, tmp_path) == first
    inbox("3.json", {"review_id": "c", "rating": 1, "review_text": "terrible, never"})
    assert run(spark, inbox, tmp_path) == first + [("c", None, 1, 1, "negative")]


def test_malformed_messages_do_not_stop_the_stream(spark, inbox, tmp_path):
    inbox("1.json", "{not json", GOOD, {"review_id": "d", "rating": "many", "review_text": "late"}, {"rating": 3})
    assert run(spark, inbox, tmp_path) == [("a", "Books", 5, 5, "positive"), ("d", None, None, 2, "negative")]
    batch = spark.read.text(inbox.path)
    assert unusable(batch).count() == 2


def test_stream_without_any_message(spark, inbox, tmp_path):
    inbox("1.json")
    assert run(spark, inbox, tmp_path) == []


def test_keyed_json_out(spark, inbox, tmp_path):
    inbox("1.json", GOOD)
    start_scoring(
        file_messages(spark, inbox.path), str(tmp_path / "ckpt"), sink="json", options={"path": str(tmp_path / "out")},
        trigger=NOW).awaitTermination()
    (row,) = spark.read.json(str(tmp_path / "out")).collect()
    assert row.key == "a" and json.loads(row.value) == {
        "review_id": "a", "category": "Books", "rating": 5, "sentiment_stars": 5, "sentiment_label": "positive"}


def test_message_round_trip(spark, reviews):
    df = reviews({"review_text": 'a "quoted"\nline'}, {"review_id": "r2", "category": None})
    back = parse_messages(to_messages(df))
    assert sorted(back.collect(), key=str) == sorted(df.select(*back.columns).collect(), key=str)


def test_serving_table_keeps_the_newest_row(spark, inbox, tmp_path):
    def feed(folder="serving"):
        messages = file_messages(spark, inbox.path).withColumn("at", F.get_json_object("value", "$.at").cast("long"))
        start_serving(
            score_messages(messages, carry=("at",)), str(tmp_path / folder), str(tmp_path / "ckpt"), NOW
        ).awaitTermination()
        return {r.review_id: r.rating for r in read_serving(spark, str(tmp_path / folder), ("at",)).collect()}

    inbox("1.json", GOOD, {"review_id": "b", "rating": 2, "review_text": "fine"})
    assert feed() == {"a": 5, "b": 2}
    inbox("2.json", {**GOOD, "rating": 1})
    assert feed() == {"a": 1, "b": 2}
    assert feed() == {"a": 1, "b": 2}
    # Inside a batch the later row wins, whatever its values.
    inbox("3.json", {**GOOD, "rating": 2, "at": 7}, {**GOOD, "rating": 5, "at": 9}, {**GOOD, "rating": 4, "at": 8})
    assert feed() == {"a": 5, "b": 2}
    compact_serving(spark, str(tmp_path / "serving"), str(tmp_path / "compact"), ("at",))
    inbox("4.json", {"review_id": "b", "rating": 1, "review_text": "fine"})
    assert feed("compact") == {"a": 5, "b": 1}
    with pytest.raises(ValueError, match="order"):
        read_serving(spark, str(tmp_path / "serving"), ())
