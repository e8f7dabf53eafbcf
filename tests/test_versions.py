"""Zones change at one moment or not at all, and appends look at their own days only."""

import json
import os
import re
import threading
from datetime import datetime

import pytest

import micro
from pyspark.sql import functions as F
from thermopolis import schemas
from thermopolis.sources import raw, sinks, versions, zones


def rows(df):
    return sorted((r["year"], r["city"]) for r in df.select("year", "city").collect())


def failing(df, column="city"):
    """The same rows, but computing the last of them is an error."""
    bad = F.raise_error(F.lit("lost on the way")).cast(df.schema[column].dataType)
    return df.withColumn(column, F.when(F.col(column) == "bad", bad).otherwise(F.col(column)))


def tables_of(spark, value):
    found = {
        "temperature_per_city": spark.createDataFrame([(f"A{value}", 1.0)], schemas.TEMPERATURE_PER_CITY),
        "consumption_ranking": spark.createDataFrame([(f"B{value}", 1.0)], schemas.CONSUMPTION_RANKING),
        "electricity_predictions": spark.createDataFrame([(f"C{value}", 1.0, 2.0, 3.0)], schemas.ELECTRICITY_PREDICTIONS),
    }
    return found


def marts(spark, path):
    return [r["city"] for n in tables_of(spark, 0) for r in zones.read_mart(spark, f"{path}/{n}", n).collect()]


# Trusted


@pytest.mark.parametrize("static", [False, True])
@pytest.mark.parametrize("after_shuffle", [False, True])
@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_a_failed_write_leaves_the_old_rows(spark, tmp_path, static, after_shuffle, fmt):
    path = str(tmp_path / "trusted")
    old = micro.trusted(spark, [{"year": y, "city": f"old{i}"} for y in (2024, 2025) for i in range(5)])
    assert sinks.write_trusted(old, path, fmt) == 10
    new = micro.trusted(spark, [{"city": f"new{i}"} for i in range(20)] + [{"city": "bad"}]).coalesce(1)
    if after_shuffle:
        # The error comes up in the tasks that write, behind an exchange of their own.
        new = failing(new.repartition(3, "city"))
    else:
        new = failing(new)
    with pytest.raises(Exception, match="lost on the way"):
        sinks.write_trusted(new, path, fmt, static, rebalance=False)
    assert zones.read_trusted(spark, path, fmt=fmt).count() == 10
    assert len(list((tmp_path / "trusted" / "data").iterdir())) == 1
    assert sinks.write_trusted(old.limit(1), path, fmt, static=True) == 1


def test_a_reader_keeps_its_version_while_another_is_published(spark, tmp_path):
    path = str(tmp_path)
    sinks.write_trusted(micro.trusted(spark, [{"city": "one"}]), path)
    before = zones.read_trusted(spark, path)
    sinks.write_trusted(micro.trusted(spark, [{"city": "two"}]), path)
    assert rows(before) == [(2025, "one")] and rows(zones.read_trusted(spark, path)) == [(2025, "two")]
    for i in range(4):
        sinks.write_trusted(micro.trusted(spark, [{"city": f"n{i}", "year": 2025 + i % 2}]), path)
    assert rows(zones.read_trusted(spark, path)) == [(2025, "n2"), (2026, "n3")]
    named = {f for v in [versions.latest(spark, path)] for f in v.tables["trusted"].values()}
    assert len(list((tmp_path / "_versions").glob("*.json"))) == versions.KEPT
    assert len(list((tmp_path / "data").iterdir())) == 3 and len(named) == 2


def test_years_without_rows_go_when_named(spark, tmp_path):
    path = str(tmp_path)
    sinks.write_trusted(micro.trusted(spark, [{"year": y} for y in (2023, 2024, None)]), path)
    sinks.write_trusted(micro.trusted(spark, [{"year": 2024, "city": "B"}]), path, years=[2023, None, 2030])
    assert rows(zones.read_trusted(spark, path)) == [(2024, "B")]


def test_a_plain_folder_is_read_and_taken_over(spark, tmp_path):
    path = str(tmp_path / "plain")
    micro.trusted(spark, [{"year": 2023}, {"year": 2024}]).write.partitionBy("year").parquet(path)
    assert rows(zones.read_trusted(spark, path)) == [(2023, "A"), (2024, "A")]
    sinks.write_trusted(micro.trusted(spark, [{"year": 2024, "city": "B"}]), path)
    assert rows(zones.read_trusted(spark, path)) == [(2023, "A"), (2024, "B")]
    text = zones.read_trusted(spark, path, 2024)._jdf.queryExecution().executedPlan().toString()
    assert text.count("PartitionFilters: [isnotnull(year") == 2


def test_two_runs_at_once_are_a_conflict(spark, tmp_path):
    path = str(tmp_path)
    sinks.write_trusted(micro.trusted(spark, [{}]), path)
    with pytest.raises(versions.ConflictError):
        with versions.commit(spark, path) as draft:
            draft.tables["trusted"] = {}
            sinks.write_trusted(micro.trusted(spark, [{"city": "other"}]), path)
    assert rows(zones.read_trusted(spark, path)) == [(2025, "other")]


def test_an_unfinished_version_does_not_count(spark, tmp_path):
    path = str(tmp_path)
    sinks.write_trusted(micro.trusted(spark, [{}]), path)
    cut = tmp_path / "_versions" / f"{2:012d}.json"
    cut.write_text('{"tables": {"trus')
    assert rows(zones.read_trusted(spark, path)) == [(2025, "A")]
    with pytest.raises(versions.ConflictError):
        sinks.write_trusted(micro.trusted(spark, [{"city": "B"}]), path)
    os.utime(cut, (0, 0))
    sinks.write_trusted(micro.trusted(spark, [{"city": "B"}]), path)
    assert rows(zones.read_trusted(spark, path)) == [(2025, "B")]


def test_what_dead_runs_have_left_goes_in_time(spark, tmp_path):
    path = str(tmp_path)
    for name in ("dead", "running"):
        (tmp_path / "data" / name).mkdir(parents=True)
    os.utime(tmp_path / "data" / "dead", (0, 0))
    sinks.write_trusted(micro.trusted(spark, [{}]), path)
    assert not (tmp_path / "data" / "dead").exists() and (tmp_path / "data" / "running").exists()


# Catalog


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_a_second_session_sees_old_or_new_rows_only(spark, tmp_path, fmt):
    path, name = str(tmp_path / "zone's"), f"moved_{fmt}"
    wanted = [{"year": y} for y in (2023, 2024, 2025, None)]
    sinks.write_trusted(micro.trusted(spark, wanted), path, fmt)
    zones.register_trusted(spark, name, path, fmt)
    other, seen, stop = spark.newSession(), set(), threading.Event()

    def read():
        while not stop.is_set():
            try:
                seen.add(tuple(sorted(r["city"] for r in other.table(name).select("city").collect())))
            except Exception as error:
                seen.add(str(error))

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for i in range(3):
            sinks.write_trusted(micro.trusted(spark, [{**w, "city": f"v{i}"} for w in wanted]), path, fmt)
            zones.register_trusted(spark, name, path, fmt)
    finally:
        stop.set()
        reader.join()
    assert seen <= {(c,) * 4 for c in ("A", "v0", "v1", "v2")}
    assert {r["city"] for r in other.table(name).where("year IS NULL").collect()} == {"v2"}
    assert len([t for t in spark.catalog.listTables() if t.name.startswith(f"{name}__")]) == versions.KEPT
    text = other.table(name).where("year = 2024")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in text
    spark.sql(f"DROP VIEW {name}")


def test_a_table_of_the_same_name_becomes_the_view(spark, tmp_path):
    path = str(tmp_path / "zone")
    micro.trusted(spark, [{}]).write.partitionBy("year").parquet(path)
    spark.sql(f"CREATE TABLE was_table (city string) USING parquet LOCATION '{path}'")
    assert rows(zones.register_trusted(spark, "was_table", path)) == [(2025, "A")]
    spark.sql("DROP VIEW was_table")


# Marts and snapshots


def test_marts_appear_together_or_not_at_all(spark, tmp_path):
    path = str(tmp_path)
    sinks.write_marts(tables_of(spark, 1), path)
    new = tables_of(spark, 2)
    new["electricity_predictions"] = failing(new["electricity_predictions"].withColumn("city", F.lit("bad")))
    with pytest.raises(Exception, match="lost on the way"):
        sinks.write_marts(new, path)
    assert marts(spark, path) == ["A1", "B1", "C1"]
    sinks.write_mart(tables_of(spark, 3)["consumption_ranking"], path, "consumption_ranking")
    assert marts(spark, path) == ["A1", "B3", "C1"]
    with pytest.raises(schemas.MissingColumnsError):
        sinks.write_marts({"temperature_per_city": new["temperature_per_city"], "consumption_ranking": spark.range(1)}, path)
    assert marts(spark, path) == ["A1", "B3", "C1"]


def test_a_failing_fifth_snapshot_leaves_all_five(spark, tmp_path):
    def made(value):
        return micro.dimensions(
            spark, cities=[(1, value, 1.5, 2.5)], regions=[(7, value)], city_region=[(1, 7)], population=[(1, 2025, 50)], city_consumption=[(1, 1, 2025, 1.0, 2.0)]
        )

    base = str(tmp_path)
    sinks.write_dimensions(made("old"), base)
    new = made("new")
    error = F.raise_error(F.lit("lost on the way")).cast("double")
    new["city_consumption"] = new["city_consumption"].withColumn("water_m3", error)
    with pytest.raises(Exception, match="lost on the way"):
        sinks.write_dimensions(raw.snapshot_tables(new.__getitem__), base)
    back = raw.read_dimensions(spark, base)
    assert [back[n].first()[1] for n in ("cities", "regions")] == ["old", "old"] and back["city_consumption"].count() == 1


# Appends


def stamped(spark, *found):
    at = [(datetime(2025, 5, 27, h), t, n, datetime(2025, 5, d, 10) if d else None) for n, d, h, t in found]
    return spark.createDataFrame(at, schemas.STAMPED_READINGS)


def test_a_fetch_twice_in_a_batch_and_two_runs(spark, tmp_path):
    path = str(tmp_path / "raw")
    batch = stamped(spark, ("A", 26, 0, 1.0), ("A", 26, 0, 1.0), ("A", 26, 1, None), ("A", 27, 0, 2.0), ("B", None, 0, 3.0), (None, 26, 0, 4.0))
    for _ in range(2):
        sinks.append_readings(batch, path)
    assert raw.read_stamped_readings(spark, path).count() == 5


def test_what_a_broken_append_has_left_out_comes_with_the_next(spark, tmp_path):
    path = str(tmp_path / "raw")
    sinks.append_readings(stamped(spark, ("A", 26, 0, 1.0)), path)
    sinks.append_readings(stamped(spark, ("A", 26, 0, 1.0), ("A", 26, 1, 2.0), ("A", 26, 2, None)), path)
    sinks.append_readings(stamped(spark, ("A", 26, 2, None)), path)
    got = raw.read_stamped_readings(spark, path).collect()
    assert sorted((r["time"].hour, r["temperature_2m"]) for r in got) == [(0, 1.0), (1, 2.0), (2, None)]


def test_only_the_days_of_the_batch_are_read(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "raw")
    sinks.append_readings(stamped(spark, *[("A", d, 0, 1.0) for d in range(1, 25)]), path)
    found = []
    not_stored = sinks._not_stored
    monkeypatch.setattr(sinks, "_not_stored", lambda *given: found.append(not_stored(*given)) or found[-1])
    sinks.append_readings(stamped(spark, ("A", 3, 0, 1.0), ("A", 3, 1, 1.0), ("A", 24, 0, 1.0)), path)
    text = found[0]._jdf.queryExecution().executedPlan().toString()
    assert "snapshot_date" in filters(text) and "IN (2025-05-03,2025-05-24)" in filters(text)
    assert raw.read_stamped_readings(spark, path).count() == 25


def filters(plan):
    return re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan)[1]


def collected(spark, *found):
    return spark.createDataFrame([(n, datetime(2025, 5, d) if d else None, t) for n, d, t in found], schemas.COLLECTED)


def test_quarantine_knows_texts_by_their_digest(spark, tmp_path, monkeypatch):
    path, plans = str(tmp_path / "bad"), []
    not_stored = sinks._not_stored
    monkeypatch.setattr(sinks, "_not_stored", lambda *given: plans.append(not_stored(*given)) or plans[-1])
    batch = collected(spark, ("A", 26, "{x"), ("A", 26, "{x"), ("A", 27, "{x"), ("B", 26, "{x"), (None, None, "{x"), ("A", 26, None), ("A", 26, ""))
    for _ in range(2):
        sinks.append_quarantine(batch, path)
    sinks.append_quarantine(collected(spark, ("A", 26, "{y"), ("A", 26, "{x")), path)
    got = raw.read_quarantine(spark, path).collect()
    assert len(got) == 7 and len({r["digest"] for r in got}) == 7
    assert sorted((r["name"] or "", r["payload"] or "-") for r in got)[-1] == ("B", "{x")
    text = plans[-1]._jdf.queryExecution().executedPlan().toString()
    for line in text.splitlines():
        if "Exchange hashpartitioning" in line or "Join" in line:
            keys = line.split("Join")[-1].split("hashpartitioning")[-1]
            assert "payload" not in keys and "digest" in keys
    assert "= 2025-05-26" in filters(text)


def test_versions_are_plain_text(spark, tmp_path):
    sinks.write_trusted(micro.trusted(spark, [{}]), str(tmp_path))
    (file,) = (tmp_path / "_versions").glob("*.json")
    found = json.loads(file.read_text())
    assert list(found["tables"]["trusted"]) == ["year=2025"] and found["notes"] == {}
