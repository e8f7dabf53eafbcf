import json
from datetime import datetime
from pathlib import Path
from types import SimpleNamespace

import pytest

import micro
from pyspark.sql import functions as F
from thermopolis import schemas
from thermopolis.functions import columns
from thermopolis.sources import raw, sinks, versions, zones


def years(df):
    return sorted((r["year"], r["city"]) for r in df.select("year", "city").collect())


def write_csv(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n")


# Raw readings


def test_readings_of_a_folder(spark, tmp_path):
    header = "time,temperature_2m,name"
    write_csv(
        tmp_path / "quito_2025-05-27T22-34-48Z.csv",
        [header, "2025-05-27T00:00,14.5,Quito", "2025-05-27T01:00,,Quito"],
    )
    write_csv(tmp_path / "lima_2025-05-27T22-34-53Z.csv", [header, "2025-05-27T00:00,abc,Lima"])
    write_csv(tmp_path / "odd.csv", [header, "2025-05-27T02:00,1,Odd"])
    df = raw.read_readings(spark, str(tmp_path), with_snapshot=True)
    got = {(r["name"], r["time"].hour): (r["temperature_2m"], r["snapshot"]) for r in df.collect()}
    assert got == {
        ("Quito", 0): (14.5, datetime(2025, 5, 27, 22, 34, 48)),
        ("Quito", 1): (None, datetime(2025, 5, 27, 22, 34, 48)),
        ("Lima", 0): (None, datetime(2025, 5, 27, 22, 34, 53)),
        ("Odd", 2): (1.0, None),
    }
    assert raw.read_readings(spark, str(tmp_path)).schema == schemas.READINGS


def test_labels_and_slugs(spark):
    df = spark.createDataFrame([("Sao Paulo X", datetime(2025, 5, 27, 22, 4, 8))], "name string, at timestamp")
    row = df.select(columns.city_slug("name").alias("slug"), columns.snapshot_label("at").alias("at")).first()
    assert tuple(row) == ("sao_paulo_x", "2025-05-27T22-04-08Z")
    name = F.concat(F.lit(row["slug"]), F.lit("_"), F.lit(row["at"]), F.lit(".csv"))
    back = df.select(columns.snapshot_from_file_name(name).alias("at")).first()["at"]
    assert back == datetime(2025, 5, 27, 22, 4, 8)


def test_append_keeps_earlier_snapshots(spark, tmp_path):
    path = str(tmp_path / "raw")
    for snap in ("2025-05-26T10:00", "2025-05-27T10:00"):
        rows = [("A", "2025-05-27T00:00", 1.0, snap)]
        sinks.append_readings(micro.stamped(spark, rows), path)
    df = raw.read_stamped_readings(spark, path)
    assert df.count() == 2
    days = {p.name for p in (tmp_path / "raw").iterdir() if p.is_dir()}
    assert days == {"snapshot_date=2025-05-26", "snapshot_date=2025-05-27"}


# Payloads


def collected(spark, texts):
    return spark.createDataFrame(
        [(f"c{i}", datetime(2025, 5, 27), t) for i, t in enumerate(texts)], schemas.COLLECTED
    )


def test_payload_edges(spark):
    good = {"latitude": 1.5, "hourly": {"time": ["2025-05-27T00:00", "2025-05-27T01:00", "2025-05-27T02:00"], "temperature_2m": [1.5, None]}}
    texts = [
        json.dumps(good),
        '{"hourly":',
        '{"error": true}',
        json.dumps(good)[:-20],
        '{"hourly": {"time": ["2025-05-27T00:00"]}}',
        '{"hourly": {"time": null, "temperature_2m": [1.0]}}',
        "",
        None,
        '{"hourly": {"time": [], "temperature_2m": []}}',
    ]
    parsed = raw.parse_payloads(collected(spark, texts))
    status = {r["name"]: r["is_good"] for r in parsed.collect()}
    assert {name for name, ok in status.items() if ok} == {"c0", "c8"}
    rows = raw.payload_readings(parsed).orderBy("time").collect()
    assert [(r["name"], r["time"], r["temperature_2m"]) for r in rows] == [
        ("c0", datetime(2025, 5, 27, 0), 1.5),
        ("c0", datetime(2025, 5, 27, 1), None),
    ]
    bad = {r["name"]: r["payload"] for r in raw.quarantined(parsed).collect()}
    assert bad == {f"c{i}": texts[i] for i in range(1, 8)}
    counts = {r["status"]: r["n_payloads"] for r in raw.payload_status(parsed).collect()}
    assert counts == {"good": 2, "quarantined": 7}


# Relational snapshots

TABLES = {
    "cities": [(1, "A", 1.5, 2.5)],
    "regions": [(7, "Land")],
    "city_region": [(1, 7)],
    "population": [(1, 2025, 50)],
    "city_consumption": [(1, 1, 2025, 10.0, 100.0)],
}


def test_snapshot_round_trip(spark, tmp_path):
    base = str(tmp_path)
    tables = micro.dimensions(spark, **TABLES)
    for _ in range(2):
        found = raw.snapshot_tables(tables.__getitem__)
        sinks.write_dimensions(found, base)
    assert list(found) == list(schemas.DIMENSIONS)
    back = raw.read_dimensions(spark, base)
    assert {n: [tuple(r) for r in df.collect()] for n, df in back.items()} == TABLES
    assert {tuple(r) for r in raw.dimension_counts(back).collect()} == {(n, 1) for n in TABLES}


def test_missing_table_is_named(spark, tmp_path):
    for name, df in micro.dimensions(spark, **TABLES).items():
        if name != "population":
            sinks.write_dimension(df, str(tmp_path), name)
    with pytest.raises(raw.MissingInputError, match="population.csv"):
        raw.read_dimensions(spark, str(tmp_path))


def test_wrong_header_is_an_error(spark, tmp_path):
    write_csv(tmp_path / "regions.csv", ["region_name,id", "Land,7"])
    with pytest.raises(Exception, match="(?i)header"):
        raw.read_dimension(spark, str(tmp_path), "regions").collect()


def test_snapshot_refuses_a_table_without_its_columns(spark):
    with pytest.raises(schemas.MissingColumnsError, match="longitude"):
        raw.snapshot_tables(lambda t: spark.createDataFrame([(1, "A", 1.0)], "id int, name string, latitude double"))


class FakeReader:
    """Records what a JDBC read would be asked for; no database is started."""

    def __init__(self, log, ends):
        self.log, self.ends, self.opts = log, ends, {}

    def format(self, name):
        assert name == "jdbc"
        return self

    def option(self, key, value):
        return self.options(**{key: value})

    def options(self, **more):
        self.opts.update(more)
        return self

    def load(self):
        self.log.append(dict(self.opts))
        return SimpleNamespace(first=lambda: self.ends)


class FakeSession:
    def __init__(self, ends=None):
        self.log, self.ends = [], ends

    @property
    def read(self):
        return FakeReader(self.log, self.ends)


def test_jdbc_read_is_split_on_the_key():
    session = FakeSession(ends=(3, 90))
    raw.jdbc_table(session, "jdbc:x", "population", {"user": "u"}, partitions=4)
    ends, whole = session.log
    assert ends["dbtable"] == "(SELECT min(city_id) AS low, max(city_id) AS high FROM population) ends"
    assert whole == {
        "url": "jdbc:x",
        "user": "u",
        "dbtable": "population",
        "partitionColumn": "city_id",
        "lowerBound": 3,
        "upperBound": 90,
        "numPartitions": 4,
    }


def test_jdbc_read_of_an_empty_table_or_one_part_is_plain():
    for session, partitions in ((FakeSession(ends=(None, None)), 4), (FakeSession(), 1)):
        raw.jdbc_table(session, "jdbc:x", "cities", partitions=partitions)
        assert session.log[-1] == {"url": "jdbc:x", "dbtable": "cities"}


# Trusted zone


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_dynamic_overwrite_keeps_other_years(spark, tmp_path, fmt):
    path = str(tmp_path / "trusted")
    assert sinks.write_trusted(micro.trusted(spark, [{"year": 2024}, {"year": 2025}, {"year": None}]), path, fmt) == 3
    assert len(list((tmp_path / "trusted").glob("data/*/year=__HIVE_DEFAULT_PARTITION__"))) == 1
    sinks.write_trusted(micro.trusted(spark, [{"year": 2025, "city": "B"}]), path, fmt)
    got = [(r["year"], r["city"]) for r in zones.read_trusted(spark, path, fmt=fmt).collect()]
    assert set(got) == {(2024, "A"), (2025, "B"), (None, "A")} and len(got) == 3
    sinks.write_trusted(micro.trusted(spark, [{"year": 2023}]), path, fmt, static=True)
    assert years(zones.read_trusted(spark, path, fmt=fmt)) == [(2023, "A")]


@pytest.mark.parametrize("static", [False, True])
def test_empty_result_is_refused(spark, tmp_path, static):
    path = str(tmp_path / "trusted")
    sinks.write_trusted(micro.trusted(spark, [{}]), path)
    empty = micro.trusted(spark, [{}]).where("city = 'nobody'")
    with pytest.raises(sinks.EmptyOutputError):
        sinks.write_trusted(empty, path, static=static)
    assert years(zones.read_trusted(spark, path)) == [(2025, "A")]


def test_year_is_pruned_and_stays_a_column(spark, tmp_path):
    path = str(tmp_path / "trusted")
    sinks.write_trusted(micro.trusted(spark, [{"year": y} for y in (2023, 2024, 2025)]), path)
    df = zones.read_trusted(spark, path, 2024)
    assert years(df) == [(2024, "A")]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert len(df.inputFiles()) == 3 and df.select(F.input_file_name()).distinct().count() == 1


def test_one_large_year_is_written_by_several_tasks(spark, tmp_path):
    """A year with nearly all rows is split by size, and rows stay whole."""
    n = 60_000
    row = micro.trusted(spark, [{}]).first().asDict()
    many = spark.range(0, n, 1, 8).select(
        *[
            F.lit(row[field.name]).cast(field.dataType).alias(field.name)
            for field in schemas.TRUSTED.fields[1:-1]
        ],
        F.sha2(F.col("id").cast("string"), 256).alias("city"),
        F.when(F.col("id") % 50 == 0, 2024).otherwise(2025).alias("year"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        path = tmp_path / "trusted"
        assert sinks.write_trusted(many, str(path)) == n
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list(path.glob("data/*/year=2025/*.parquet"))) > 2
    assert zones.read_trusted(spark, str(path)).count() == n


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_catalog_table(spark, tmp_path, fmt):
    path = str(tmp_path / "it's trusted")
    sinks.write_trusted(micro.trusted(spark, [{"year": 2024}, {"year": 2025}]), path, fmt)
    name = f"trusted_{fmt}"
    try:
        table = zones.register_trusted(spark, name, path, fmt)
        assert years(table) == [(2024, "A"), (2025, "A")]
        assert table.schema == schemas.TRUSTED
        sinks.write_trusted(micro.trusted(spark, [{"year": 2026}]), path, fmt)
        assert years(zones.register_trusted(spark, name, path, fmt))[-1] == (2026, "A")
    finally:
        spark.sql(f"DROP VIEW IF EXISTS {name}")


# Marts


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_mart_keeps_every_part(spark, tmp_path, fmt):
    df = spark.range(100).select(
        F.col("id").cast("string").alias("city"), F.col("id").cast("double").alias("mean_temp")
    )
    for _ in range(2):
        sinks.write_mart(df.repartition(5), str(tmp_path), "temperature_per_city", fmt)
    (place,) = versions.places(spark, str(tmp_path), "temperature_per_city")
    assert len(list(Path(place).glob(f"part-*.{fmt}*"))) == 5
    back = zones.read_mart(spark, str(tmp_path / "temperature_per_city"), "temperature_per_city", fmt)
    assert back.count() == 100 and back.schema == schemas.TEMPERATURE_PER_CITY


def test_legacy_name_and_missing_columns(spark, tmp_path):
    write_csv(tmp_path / "old" / "part-0.csv", ["city,avg_kwh_pe", "A,1.5"])
    back = zones.read_mart(spark, str(tmp_path / "old"), "consumption_ranking", "csv")
    assert [tuple(r) for r in back.collect()] == [("A", 1.5)]
    with pytest.raises(schemas.MissingColumnsError, match="mean_temp"):
        zones.read_mart(spark, str(tmp_path / "old"), "temperature_per_city", "csv")
    df = spark.createDataFrame([("A", 1.0)], "city string, other double")
    with pytest.raises(schemas.MissingColumnsError):
        sinks.write_mart(df, str(tmp_path), "temperature_per_city")
