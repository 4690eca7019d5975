"""Landing by header, versions of Silver and Gold, and their crash safety."""

from __future__ import annotations

import gzip
import os

import pytest
from pyspark.sql import functions as F

from plaudit.operators.quality import DataQualityError
from plaudit.plans import increments, marts, warehouse
from plaudit.plans.batch import run_batch
from plaudit.plans.lake_jobs import bronze_to_silver
from plaudit.sources import landing, versions
from plaudit.sources.lake import CSV_OPTIONS, Lake, bronze_files, land, land_csv, read_bronze, read_silver


def day(text):
    return F.lit(text).cast("date")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def same_as_rebuild(spark, lake, as_of=None):
    bronze_to_silver(spark, lake, as_of)
    silver = increments.read_silver_version(spark, lake)
    assert rows(silver) == rows(read_silver(spark, lake).select(*silver.columns))
    for name, mart in marts.GOLD_MARTS.items():
        assert rows(increments.read_gold(spark, lake, name)) == rows(mart(silver)), name


HEADER = "review_id,product_id,product_name,category,customer_id,rating,review_text,topic,review_date\n"


def test_files_are_landed_by_their_own_headers(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.csv").write_text(HEADER + 'r1,p1,Lamp,Books,c1,5,"two\nlines",price,2024-01-01\nr2,p2,Lamp,Books,c1,4,short\n')
    (source / "b.csv").write_text(
        "﻿product_id,review_id,rating,review_text,review_date,colour,review_text\n"
        'p9,r9,3,fine,2024-02-01,"red ""dark""",second text\np8,r8,2,poor,2024-02-01,,\np7,r7,1,bad,2024-02-01,,,surplus\n')
    (source / "empty.csv").write_text("")
    (source / "_hidden.csv").write_text("nonsense\n")
    with gzip.open(source / "c.csv.gz", "wt") as packed:
        packed.write(HEADER + "r3,p3,Lamp,Books,c3,3,packed text,price,2024-01-03\n")
    lake = Lake(str(tmp_path / "lake"))
    land_csv(spark, lake, str(source))
    landed = {r.review_id: r for r in read_bronze(spark, lake, rescued=True).collect()}
    assert set(landed) == {"r1", "r2", "r3", "r7", "r8", "r9"}
    assert landed["r1"].review_text == "two\nlines" and landed["r1"].rescued is None
    assert (landed["r9"].product_id, landed["r9"].product_name) == ("p9", None)
    assert landed["r9"].review_text == "fine"
    rescued = spark.createDataFrame([(k, r.rescued) for k, r in landed.items()], "id string, rescued string").select(
        "id", F.from_json("rescued", "map<string,string>").alias("m"))
    cells = {r.id: r.m for r in rescued.collect()}
    assert cells["r9"] == {"colour": 'red "dark"', "review_text_2": "second text"} and cells["r8"] is None
    assert cells["r7"] == {"_record": "p7,r7,1,bad,2024-02-01,,,surplus"} and "short" in cells["r2"]["_record"]


def test_a_file_without_required_columns_is_refused_and_reported(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.csv").write_text(HEADER + "r1,p1,Lamp,Books,c1,5,text,price,2024-01-01\n")
    (source / "b.csv").write_text("review_id,stars\nr2,5\n")
    lake = Lake(str(tmp_path / "lake"))
    with pytest.raises(ValueError, match="b.csv lacks"):
        land_csv(spark, lake, str(source))
    assert bronze_files(spark, lake) == []
    report = {os.path.basename(r.path): r for r in landing.landing_report(spark, landing.landing_files(spark, str(source))).collect()}
    assert report["a.csv"].landed and not report["b.csv"].landed
    assert report["b.csv"].unknown == ["stars"] and "rating" in report["b.csv"].missing
    with pytest.raises(FileNotFoundError):
        land_csv(spark, lake, str(tmp_path / "nothing"))


def test_a_big_file_without_quoted_breaks_is_read_in_several_tasks(spark, tmp_path, monkeypatch):
    lines = [f'r{i},p1,"Lamp ""x""",Books,c1,5,text number {i},price,2024-01-01\n' for i in range(4000)]
    (tmp_path / "plain.csv").write_text(HEADER + "".join(lines))
    (tmp_path / "broken.csv").write_text(HEADER + "".join(lines) + 'z,p1,Lamp,Books,c1,5,"a\nb",price,2024-01-01\n')
    monkeypatch.setattr(landing, "ONE_TASK_BYTES", 1000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32KB")
    try:
        tasks = {}
        for name in ("plain", "broken"):
            found = landing.landing_files(spark, str(tmp_path / f"{name}.csv"))
            df = landing.read_by_header(spark, found, CSV_OPTIONS)
            tasks[name] = df.rdd.getNumPartitions()
            assert df.select("review_id").distinct().count() == 4000 + (name == "broken")
        assert tasks["plain"] > 4 and tasks["broken"] == 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_increments_equal_a_rebuild(spark, reviews, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    land(reviews(
        {"review_id": "a", "review_date": "2024-01-05"}, {"review_id": "b", "category": "Beauty", "rating": 2},
        {"review_id": "c", "category": None, "product_id": None, "review_date": "2024-03-01"},
        {"review_id": "x", "review_text": " "}, {"review_id": "keep", "category": "Fashion"}), lake)
    first = increments.refresh_silver(spark, lake)
    increments.refresh_gold(spark, lake)
    assert first.counts == {"raw": 5, "silver": 4}
    same_as_rebuild(spark, lake)

    # An earlier row of "a" in another category, an earlier one of "c", a later one of "b", and a new one.
    land(reviews(
        {"review_id": "a", "review_date": "2024-01-02", "category": "Beauty"}, {"review_id": "b", "review_date": "2024-02-01"},
        {"review_id": "c", "category": None, "product_id": None, "review_date": "2024-02-15", "rating": 1},
        {"review_id": "d", "category": "Beauty"}), lake)
    second = increments.refresh_silver(spark, lake)
    increments.refresh_gold(spark, lake)
    assert second.counts == {"raw": 9, "silver": 5}
    same_as_rebuild(spark, lake)
    # "Beauty" only gained, "Books" lost its only row, the null category was rewritten, "Fashion" stayed.
    before, after = first.manifest["folders"], second.manifest["folders"]
    assert after["category=Beauty"][:1] == before["category=Beauty"] and len(after["category=Beauty"]) == 2
    assert "category=Books" not in after and after["category=Fashion"] == before["category=Fashion"]
    null = "category=__HIVE_DEFAULT_PARTITION__"
    assert len(after[null]) == 1 and after[null] != before[null]

    third = increments.refresh_silver(spark, lake)  # nothing new
    increments.refresh_gold(spark, lake)
    assert third.counts == second.counts and third.manifest["folders"] == second.manifest["folders"]
    same_as_rebuild(spark, lake)


def test_a_load_writes_its_rows_once_before_they_are_compared(spark, tmp_path, monkeypatch):
    lake = Lake(str(tmp_path / "lake"))
    names = "review_id, product_id, product_name, category, customer_id, rating, review_text, topic, review_date"
    make = lambda *found: spark.createDataFrame(list(found), names.replace(",", " string,").replace(
        "rating string", "rating int") + " string")
    row = lambda key, product, date: (key, product, "name", "kind", None, 3, "text " + key, None, date)
    written, write = [], increments.materialise
    monkeypatch.setattr(increments, "materialise", lambda df, name: written.append(name) or write(df, name))
    loads = [
        [row("same", "p", "2024-01-02"), row("null", "p", "2024-01-02"), row("early", "p", "2024-01-02"),
         row("late", "p", "2024-01-02"), row("alone", None, "2024-01-02")],
        [row("same", "p", "2024-01-02"), row("null", None, "2024-01-02"), row("early", "p", "2024-01-01"),
         row("early", "q", "2024-01-01"), row("late", "p", "2024-01-03"), row("new", "p", "2024-01-02"), row("new", "p", "2024-01-02")]]
    for load in loads:
        land(make(*load), lake)
        found = increments.refresh_silver(spark, lake)
    assert written == ["checked", "checked"]
    increments.refresh_gold(spark, lake)
    changes = spark.read.parquet(f"{lake.path('silver', increments.STORE)}/{found.manifest['changes']}")
    assert sorted(tuple(r) for r in changes.select("review_id", "sign").collect()) == [
        ("early", -1), ("early", 1), ("new", 1), ("null", -1), ("null", 1)]
    assert found.counts == {"raw": 12, "silver": 6}
    same_as_rebuild(spark, lake)


def test_a_second_load_reads_only_new_files(spark, reviews, tmp_path, monkeypatch):
    lake = Lake(str(tmp_path / "lake"))
    land(reviews({"review_id": "a"}), lake)
    increments.refresh_silver(spark, lake)
    old = set(bronze_files(spark, lake))
    land(reviews({"review_id": "b"}), lake)
    read = []
    monkeypatch.setattr(increments, "read_landed", lambda s, k, paths, _f=increments.read_landed: read.extend(paths) or _f(s, k, paths))
    assert increments.refresh_silver(spark, lake).counts == {"raw": 2, "silver": 2}
    assert {os.path.basename(path) for path in read} == {os.path.basename(path) for path in set(bronze_files(spark, lake)) - old}


def test_future_rows_wait_and_full_folders_are_rewritten(spark, reviews, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    for number, until in enumerate(("2024-01-10", "2024-01-20", "2024-01-30")):
        land(reviews(
            {"review_id": f"r{number}", "review_date": "2024-01-01"},
            {"review_id": f"f{number}", "review_date": f"2024-01-{15 + 10 * number}"}), lake)
        loaded = increments.refresh_silver(spark, lake, day(until), max_parts=2)
        increments.refresh_gold(spark, lake)
        same_as_rebuild(spark, lake, day(until))
        assert len(loaded.manifest["folders"]["category=Books"]) <= 2
    assert loaded.counts == {"raw": 6, "silver": 5}


def test_a_refused_or_failed_version_leaves_the_old_one(spark, reviews, tmp_path, monkeypatch):
    lake = Lake(str(tmp_path / "lake"))
    land(reviews({"review_id": "a"}), lake)
    increments.refresh_silver(spark, lake)
    increments.refresh_gold(spark, lake)
    before, gold = rows(increments.read_silver_version(spark, lake)), rows(increments.read_gold(spark, lake, "product_summary"))
    land(reviews({"review_id": "b"}, {"review_id": "a", "review_date": "2023-01-01"}), lake)
    seen = []

    def refuse(candidate):
        seen.extend(rows(candidate.select("review_id")))
        raise RuntimeError("refused")

    with pytest.raises(RuntimeError, match="refused"):
        increments.refresh_silver(spark, lake, accept=refuse)
    monkeypatch.setattr(increments, "_written", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError, match="lost"):
        increments.refresh_silver(spark, lake)
    monkeypatch.undo()
    assert seen == [("a",), ("b",)]
    assert rows(increments.read_silver_version(spark, lake)) == before
    increments.refresh_gold(spark, lake)
    assert rows(increments.read_gold(spark, lake, "product_summary")) == gold
    assert increments.refresh_silver(spark, lake).counts == {"raw": 3, "silver": 2}
    increments.refresh_gold(spark, lake)
    same_as_rebuild(spark, lake)


def test_of_two_writers_one_fails(spark, reviews, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    land(reviews({"review_id": "a"}), lake)
    with pytest.raises(FileExistsError):
        increments.refresh_silver(spark, lake, accept=lambda _: increments.refresh_silver(spark, lake))
    assert increments.read_silver_version(spark, lake).count() == 1


def test_empty_markers_are_no_versions(spark, tmp_path):
    folder = str(tmp_path / "versions")
    assert versions.published(spark, folder) == {} and versions.latest(spark, folder) is None
    versions.publish(spark, folder, 1, '{"a": "ü"}')
    (tmp_path / "versions" / f"{2:012d}").write_text("")
    assert versions.latest(spark, folder) == (1, {"a": "ü"}) and versions.next_number(spark, folder) == 3
    with pytest.raises(FileExistsError):
        versions.publish(spark, folder, 1, "again")
    assert not [name for name in os.listdir(folder) if name.startswith(".0") and not name.endswith(".crc")]
    (tmp_path / "_loads").mkdir()
    (tmp_path / "_loads" / f"{1:012d}").write_text("")
    assert warehouse.read_star(spark, str(tmp_path)).fact_reviews.count() == 0


def test_a_failed_gate_leaves_silver_as_it_was(spark, many_reviews, reviews, tmp_path):
    from plaudit.sources.lake import write_csv

    lake, root = Lake(str(tmp_path / "lake")), str(tmp_path / "warehouse")
    write_csv(many_reviews(50), str(tmp_path / "good"))
    run_batch(spark, lake, str(tmp_path / "good"), root, load="l1", flag=warehouse.rule_flagged)
    before = rows(increments.read_silver_version(spark, lake))
    write_csv(reviews({"review_id": "bad", "category": "Groceries"}), str(tmp_path / "bad"))
    with pytest.raises(DataQualityError):
        run_batch(spark, lake, str(tmp_path / "bad"), root, load="l2", flag=warehouse.rule_flagged)
    assert rows(increments.read_silver_version(spark, lake)) == before
    assert lake.read_mart(spark, "product_summary").count() == 25
