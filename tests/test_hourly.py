"""Hourly runs over new fetches give the rows of a full run; audits need no second scan."""

import random
import shutil
from datetime import datetime, timedelta
from decimal import Decimal

import pytest

import micro
from pyspark.sql import functions as F
from thermopolis import schemas
from thermopolis.operators import daily
from thermopolis.plans import etl, hourly
from thermopolis.sources import daystate, raw, sinks, versions, zones


def fetches(spark, rng, days, cities=6):
    """Overlapping fetches: each holds three days of hours from its own day on, values with many digits."""
    rows = []
    for day in days:
        for hour in (6, 18):
            stamp = datetime(2025, 5, 1) + timedelta(days=day, hours=hour)
            for city in range(cities):
                start = datetime(2025, 5, 1) + timedelta(days=day - 1)
                rows += [(start + timedelta(hours=h), rng.choice([None, rng.uniform(-30, 40), 0.1 * rng.randrange(300)]), f"City {city}", stamp) for h in range(0, 72, 5)]
    return spark.createDataFrame(rows, schemas.STAMPED_READINGS)


def snapshots(spark, path, cities=6, people=50):
    tables = micro.dimensions(
        spark,
        cities=[(i, f"City {i}", float(i), -float(i)) for i in range(cities)],
        regions=[(1, "Land")],
        city_region=[(i, 1) for i in range(cities)],
        population=[(i, 2020 + i % 2, people + i) for i in range(cities)],
        city_consumption=[(i, i, 2020 + i % 2, 10.0 * i, 100.0 + i * i) for i in range(1, cities)],
    )
    sinks.write_dimensions(tables, path)


def table(spark, path):
    found = [tuple(r) for r in zones.read_trusted(spark, path).collect()]
    assert len(found) == len(set(found)) > 0
    return set(found)


class Zone:
    def __init__(self, base):
        self.readings, self.dimensions, self.output, self.state, self.full = (str(base / x) for x in ("raw", "dims", "out", "state", "full"))

    def hourly(self, spark, dedupe):
        return hourly.run(spark, self.readings, self.dimensions, self.output, self.state, dedupe=dedupe)

    def check(self, spark, dedupe):
        etl.run(spark, self.readings, self.dimensions, self.full, dedupe=dedupe, stamped=True)
        assert table(spark, self.output) == table(spark, self.full)


@pytest.fixture
def zone(spark, tmp_path):
    zone = Zone(tmp_path)
    snapshots(spark, zone.dimensions)
    return zone


@pytest.mark.parametrize("dedupe", ["none", "latest"])
def test_run_after_run_equals_the_full_run(spark, zone, dedupe):
    rng = random.Random(3)
    sinks.append_readings(fetches(spark, rng, [0, 1]), zone.readings)
    first = zone.hourly(spark, dedupe)
    assert first["fetch_days"] == 2 and first["years"] == 3
    zone.check(spark, dedupe)
    for days in ([2], [3, 4], [1, 9]):
        # The second fetch of a day, late ones and a day of its own.
        sinks.append_readings(fetches(spark, rng, days).union(fetches(spark, rng, [days[0]]).withColumn("snapshot", F.expr("snapshot + interval 3 hours"))), zone.readings)
        counts = zone.hourly(spark, dedupe)
        assert counts["fetch_days"] == len(days) and counts["days"] <= 3 * len(days)
        zone.check(spark, dedupe)
    again = zone.hourly(spark, dedupe)
    assert again == {"fetch_days": 0, "days": 0, "years": 0, "rows": 0}
    found = hourly.audit(spark, zone.dimensions, zone.output, zone.state)
    readings = raw.read_stamped_readings(spark, zone.readings)
    assert found == etl.run_audited(spark, zone.readings, zone.dimensions, zone.full, dedupe=dedupe, stamped=True)
    assert found["readings"] == readings.count()


def test_only_changed_years_are_written(spark, zone):
    rng = random.Random(4)
    sinks.append_readings(fetches(spark, rng, [0, 1]), zone.readings)
    zone.hourly(spark, "none")
    before = versions.latest(spark, zone.output).tables["trusted"]
    sinks.append_readings(fetches(spark, rng, [2]).where("name in ('City 1', 'City 3')"), zone.readings)
    assert zone.hourly(spark, "none")["years"] == 1
    after = versions.latest(spark, zone.output).tables["trusted"]
    assert {p for p in after if after[p] != before[p]} == {"year=2021"} and before.keys() == after.keys()
    zone.check(spark, "none")


def test_new_snapshots_replace_all_years_without_reading_fetches(spark, zone, monkeypatch):
    sinks.append_readings(fetches(spark, random.Random(5), [0]), zone.readings)
    zone.hourly(spark, "none")
    snapshots(spark, zone.dimensions, cities=4, people=900)
    monkeypatch.setattr(daystate, "compute_parts", None)
    counts = zone.hourly(spark, "none")
    assert counts["years"] == 3 and counts["days"] == 0
    zone.check(spark, "none")
    assert {r["population"] for r in zones.read_trusted(spark, zone.output).collect()} >= {901, 902, 903}


def test_only_new_fetch_days_and_their_days_are_read(spark, zone, monkeypatch):
    rng, read = random.Random(6), []
    sinks.append_readings(fetches(spark, rng, range(0, 40, 4)), zone.readings)
    zone.hourly(spark, "none")
    plain, parts = daystate.compute_parts, daystate.read
    monkeypatch.setattr(daystate, "compute_parts", lambda *a: read.append(plain(*a)) or read[-1])
    asked = []
    monkeypatch.setattr(daystate, "read", lambda *a: asked.append((a[3], a[5] if len(a) > 5 else None)) or parts(*a))
    sinks.append_readings(fetches(spark, rng, [41]), zone.readings)
    zone.hourly(spark, "none")
    assert {name.split("/")[-2] for name in read[0].inputFiles()} == {"snapshot_date=2025-06-11"}
    # Its days are of no other fetch day.
    assert [days for name, days in asked if name == daystate.PARTS] == [{"2025-06-11"}, {"2025-06-11"}]
    zone.check(spark, "none")


def test_a_run_that_dies_is_repeated(spark, zone, monkeypatch):
    rng = random.Random(7)
    sinks.append_readings(fetches(spark, rng, [0, 1]), zone.readings)
    zone.hourly(spark, "latest")
    old = table(spark, zone.output)
    sinks.append_readings(fetches(spark, rng, [2]), zone.readings)

    def lost(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(sinks, "write_trusted", lost)
        with pytest.raises(RuntimeError, match="lost"):
            zone.hourly(spark, "latest")
    assert table(spark, zone.output) == old
    # Between the two versions: trusted is new, the state is not.
    publish = versions._publish
    with monkeypatch.context() as m:
        m.setattr(versions, "_publish", lambda files, draft: lost() if files.root == zone.state else publish(files, draft))
        with pytest.raises(RuntimeError, match="lost"):
            zone.hourly(spark, "latest")
    assert zone.hourly(spark, "latest")["fetch_days"] == 1
    zone.check(spark, "latest")


def test_a_fetch_day_that_goes_takes_its_readings_along(spark, zone):
    rng = random.Random(8)
    sinks.append_readings(fetches(spark, rng, [0, 5]), zone.readings)
    zone.hourly(spark, "none")
    shutil.rmtree(f"{zone.readings}/snapshot_date=2025-05-06")
    assert zone.hourly(spark, "none")["fetch_days"] == 1
    zone.check(spark, "none")


def test_unknown_times_and_stamps_and_another_dedupe(spark, zone):
    rows = [(None, 1.0, "City 1", datetime(2025, 5, 1)), (datetime(2025, 5, 1), 2.0, "City 1", None), (datetime(2025, 5, 1), None, None, None)]
    sinks.append_readings(spark.createDataFrame(rows, schemas.STAMPED_READINGS), zone.readings)
    zone.hourly(spark, "none")
    zone.check(spark, "none")
    sinks.append_readings(fetches(spark, random.Random(9), [0]), zone.readings)
    assert zone.hourly(spark, "latest")["fetch_days"] == 2
    zone.check(spark, "latest")


def test_no_known_city_leaves_the_old_rows(spark, zone):
    sinks.append_readings(fetches(spark, random.Random(1), [0]).withColumn("name", F.lit("Nowhere")), zone.readings)
    with pytest.raises(sinks.EmptyOutputError):
        zone.hourly(spark, "none")
    assert versions.latest(spark, zone.state) is None


# The parts themselves


@pytest.mark.parametrize("dedupe", ["none", "latest"])
def test_parts_add_up_to_the_same_bits_in_any_order(spark, dedupe):
    rng = random.Random(2)
    readings = fetches(spark, rng, range(6)).union(
        spark.createDataFrame([(datetime(2025, 5, 3), v, "odd", datetime(2025, 5, 3, h)) for h, v in enumerate([float("nan"), 1e300, 0.1, None])], schemas.STAMPED_READINGS)
    )
    wanted = None
    for n in (1, 3, 7):
        parts = readings.repartition(n).withColumn("part", F.pmod(F.hash("snapshot", F.lit(n)), F.lit(n)))
        got = {tuple(map(repr, r)) for r in daily.merge_days(daily.partial_days(parts, dedupe, "part"), dedupe).collect()}
        assert wanted is None or got == wanted
        wanted = got
    plain = {(r["name"], r["date"]): r for r in daily.daily_weather(readings, dedupe).collect()}
    merged = daily.merge_days(daily.partial_days(readings, dedupe), dedupe).collect()
    assert len(merged) == len(plain)
    for r in merged:
        other = plain[r["name"], r["date"]]
        assert (r["min_temperature"], r["max_temperature"]) == pytest.approx((other["min_temperature"], other["max_temperature"]), nan_ok=True)
        means = (r["avg_temperature"], other["avg_temperature"])
        assert means == (None, None) or means[0] == pytest.approx(means[1], rel=1e-12, nan_ok=True)


def test_the_average_is_that_of_the_digits(spark):
    values = [0.1, 0.2, 0.3, 1e8, -1e8, 12.3456789012]
    rows = spark.createDataFrame([(datetime(2025, 5, 1, h), v, "A", None) for h, v in enumerate(values)], schemas.STAMPED_READINGS)
    (got,) = daily.merge_days(daily.partial_days(rows)).collect()
    assert got["avg_temperature"] == float(sum(Decimal(repr(v)) for v in values)) / len(values)


# Audit


@pytest.mark.parametrize("dedupe", ["none", "latest"])
def test_the_audit_needs_no_second_scan(spark, zone, monkeypatch, dedupe):
    sinks.append_readings(fetches(spark, random.Random(3), [0, 1]), zone.readings)
    write = sinks.write_trusted
    scans = []
    monkeypatch.setattr(raw, "read_stamped_readings", lambda s, p, real=raw.read_stamped_readings: scans.append(p) or real(s, p))

    def write_and_forget(*args, **kwargs):
        done = write(*args, **kwargs)
        shutil.move(zone.readings, zone.readings + "-gone")
        return done

    monkeypatch.setattr(sinks, "write_trusted", write_and_forget)
    counts = etl.run_audited(spark, zone.readings, zone.dimensions, zone.output, dedupe=dedupe, stamped=True)
    assert len(scans) == 1
    assert counts["final"] == zones.read_trusted(spark, zone.output).count()
    assert counts["readings"] == spark.read.parquet(zone.readings + "-gone").count() and counts["city_info"] == 6
