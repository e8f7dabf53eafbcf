"""The three jobs end to end on files."""

import json
from datetime import datetime

import pytest

import micro
from thermopolis import schemas, session
from thermopolis.plans import analysis, etl, ingest
from thermopolis.sources import raw, sinks, zones


@pytest.fixture(scope="module")
def raw_zone(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("zones")
    lines = []
    for i in range(30):
        for fetch in (26, 27):
            times = [f"2025-05-{d}T{h:02d}:00" for d in (27, 28, 29) for h in range(0, 24, 6)]
            temps = [10.0 + i + h % 7 + fetch for h in range(len(times))]
            body = json.dumps({"hourly": {"time": times, "temperature_2m": temps}})
            lines.append({"name": f"City {i}", "snapshot": f"2025-05-{fetch}T10:00:00Z", "payload": body})
    lines.append({"name": "Broken", "snapshot": "2025-05-27T10:00:00Z", "payload": '{"hourly":'})
    (base / "collected").mkdir()
    (base / "collected" / "a.json").write_text("\n".join(map(json.dumps, lines)))
    ingest.ingest_payloads(
        spark, str(base / "collected"), str(base / "readings"), str(base / "quarantine")
    )
    tables = micro.dimensions(
        spark,
        cities=[(i, f"City {i}", float(i), -float(i)) for i in range(30)],
        regions=[(1, "Land")],
        city_region=[(i, 1) for i in range(29)],
        population=[(i, 2025, i) for i in range(30)],
        city_consumption=[(i, i, 2025, 10.0 * i, 100.0 + i * i) for i in range(30)],
    )
    sinks.write_dimensions(tables, str(base / "tables"))
    return base


def test_ingest(spark, raw_zone):
    readings = raw.read_stamped_readings(spark, str(raw_zone / "readings"))
    assert readings.count() == 30 * 2 * 12
    bad = raw.read_quarantine(spark, str(raw_zone / "quarantine")).drop("digest").collect()
    assert [tuple(r) for r in bad] == [("Broken", datetime(2025, 5, 27, 10), '{"hourly":')]


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_etl_and_analysis(spark, raw_zone, tmp_path, fmt):
    trusted, refined = str(tmp_path / "trusted"), str(tmp_path / "refined")
    rows = etl.run(
        spark, str(raw_zone / "readings"), str(raw_zone / "tables"), trusted, fmt, "latest", stamped=True
    )
    assert rows == 90
    got = zones.read_trusted(spark, trusted, 2025, fmt).where("city = 'City 29'").collect()
    assert {(r["country"], r["population"]) for r in got} == {("Unknown", 29)}
    assert min(r["min_temperature"] for r in got) == 10.0 + 29 + 27

    reports = analysis.run(spark, trusted, refined, 2025, fmt)
    assert {n: df.count() for n, df in reports.items()} == {
        "rmse_report": 2,
        "cluster_sizes": 5,
        "correlation_matrix": 36,
        "descriptive_stats": 4,
        "kwh_quartiles": 1,
        "kwh_outlier_count": 1,
    }
    ranking = zones.read_mart(spark, f"{refined}/consumption_ranking", "consumption_ranking", fmt)
    assert ranking.count() == 30
    assert ranking.where("avg_kwh_per_person IS NULL").first()["city"] == "City 0"
    means = zones.read_mart(spark, f"{refined}/temperature_per_city", "temperature_per_city", fmt)
    assert means.count() == 30
    mart = zones.read_mart(spark, f"{refined}/electricity_predictions", "electricity_predictions", fmt)
    assert 0 < mart.count() < 90


def test_etl_without_matching_names_keeps_the_old_output(spark, raw_zone, tmp_path):
    trusted = str(tmp_path / "trusted")
    sinks.write_trusted(micro.trusted(spark, [{}]), trusted)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x_2025-05-27T22-34-48Z.csv").write_text(
        "time,temperature_2m,name\n2025-05-27T00:00,1.0,Nowhere\n"
    )
    with pytest.raises(sinks.EmptyOutputError):
        etl.run(spark, str(tmp_path / "in"), str(raw_zone / "tables"), trusted)
    assert zones.read_trusted(spark, trusted).count() == 1


def test_sizes_grow_with_the_input_and_stay_bounded():
    def sizes(n):
        return tuple(session.sizing(n, cores=8).values())

    assert sizes(0) == (128 * session.MIB, 8)
    assert sizes(100 * session.GIB) == (128 * session.MIB, 800)
    assert sizes(100 * 1024 * session.GIB) == (session.GIB, 50_000)


def test_materialized_rows_come_from_the_named_folder(spark):
    folder = spark.sparkContext.getConf().get(session.CHECKPOINT_KEY)
    df = session.materialize(spark.range(10).selectExpr("id * 2 AS x", "id AS y"))
    assert all(f"{folder}/" in name for name in df.inputFiles())
    assert "ReadSchema: struct<x:bigint>" in df.select("x")._jdf.queryExecution().executedPlan().toString()
    assert df.count() == 10


def test_ingest_twice_and_broken_lines(spark, tmp_path):
    good = {"hourly": {"time": ["2025-05-27T00:00"], "temperature_2m": [1.5]}}
    odd_time = {"hourly": {"time": ["2025-05-27T00:00", "yesterday"], "temperature_2m": [1.5, 2.5]}}
    stamp = "2025-05-27T10:00:00Z"
    lines = [
        json.dumps({"name": "A", "snapshot": stamp, "payload": json.dumps(good)}),
        json.dumps({"name": "B", "snapshot": stamp, "payload": json.dumps(odd_time)}),
        '{"name": "C", "snapshot": "2025',
        '{"note": "no answer"}',
    ]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(lines))
    where = [str(tmp_path / x) for x in ("in", "readings", "quarantine")]
    for _ in range(2):
        ingest.ingest_payloads(spark, *where)
    assert [r["name"] for r in raw.read_stamped_readings(spark, where[1]).collect()] == ["A"]
    bad = raw.read_quarantine(spark, where[2]).collect()
    assert sorted((r["name"] or "", r["payload"]) for r in bad) == [("", lines[2]), ("", lines[3]), ("B", json.dumps(odd_time))]


def test_a_city_leaves_the_unknown_year(spark, raw_zone, tmp_path):
    tables = raw.read_dimensions(spark, str(raw_zone / "tables"))
    for name, df in tables.items():
        sinks.write_dimension(df.limit(0) if name == "city_consumption" else df, str(tmp_path / "first"), name)
    out = str(tmp_path / "trusted")
    for dimensions in (tmp_path / "first", raw_zone / "tables"):
        etl.run(spark, str(raw_zone / "readings"), str(dimensions), out, stamped=True)
    years = {r["year"] for r in zones.read_trusted(spark, out).where("city = 'City 3'").collect()}
    assert years == {2025}
