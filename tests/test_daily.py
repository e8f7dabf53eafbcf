import random
from collections import defaultdict

import pytest

import micro
from thermopolis import schemas
from thermopolis.operators.daily import daily_weather, latest_readings


def by_key(df):
    return {(r["name"], r["date"]): tuple(r)[2:] for r in df.collect()}


def test_null_temperature_is_ignored_but_its_day_is_kept(spark):
    rows = [("A", "2025-05-27T00:00", 10.0), ("A", "2025-05-27T01:00", None), ("B", "2025-05-27T00:00", None)]
    assert by_key(daily_weather(micro.readings(spark, rows))) == {
        ("A", "2025-05-27"): (10.0, 10.0, 10.0),
        ("B", "2025-05-27"): (None, None, None),
    }


def test_overlapping_snapshots(spark):
    rows = [
        ("A", "2025-05-27T00:00", 10.0, "2025-05-26T10:00"),
        ("A", "2025-05-27T00:00", 20.0, "2025-05-26T11:00"),
        ("A", "2025-05-27T01:00", 40.0, "2025-05-26T10:00"),
        ("A", "2025-05-27T02:00", 7.0, "2025-05-26T10:00"),
        ("A", "2025-05-27T02:00", None, "2025-05-26T12:00"),
    ]
    df = micro.stamped(spark, rows)
    assert by_key(daily_weather(df))[("A", "2025-05-27")] == (77.0 / 4, 7.0, 40.0)
    # The newest copy of the third hour is unknown, and stays so.
    assert by_key(daily_weather(df, dedupe="latest"))[("A", "2025-05-27")] == (30.0, 20.0, 40.0)


def test_copies_of_unknown_age_count_as_oldest(spark):
    df = micro.stamped(spark, [("A", "2025-05-27T00:00", 10.0, "2025-05-26T10:00")]).unionAll(
        spark.createDataFrame(
            [
                (micro.at("2025-05-27T00:00"), 99.0, "A", None),
                (micro.at("2025-05-27T01:00"), 20.0, "A", None),
                (micro.at("2025-05-27T01:00"), 30.0, "A", None),
            ],
            schemas.STAMPED_READINGS,
        )
    )
    assert sorted(r["temperature_2m"] for r in latest_readings(df).collect()) == [10.0, 30.0]


def test_equal_stamps_and_times_within_an_hour(spark):
    rows = [("A", f"2025-05-27T00:{m:02d}", float(m), "2025-05-26T10:00") for m in (0, 30, 45)]
    rows += [("A", "2025-05-27T00:00", t, "2025-05-26T10:00") for t in (9.0, 2.0, 1.0)]
    df = micro.stamped(spark, rows)
    for layout in (df.repartition(1), df.repartition(5), df.orderBy("temperature_2m").coalesce(2)):
        got = sorted(r["temperature_2m"] for r in latest_readings(layout).collect())
        assert got == [9.0, 30.0, 45.0]


def test_unknown_dedupe_is_refused(spark):
    with pytest.raises(ValueError):
        daily_weather(micro.readings(spark, []), dedupe="first")


def test_latest_against_brute_force_with_a_hot_city(spark):
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        name = "hot" if i % 3 == 0 else f"c{rng.randrange(40)}"
        hour = f"2025-05-{rng.randrange(27, 30)}T{rng.randrange(24):02d}:00"
        rows.append((name, hour, round(rng.uniform(-10, 40), 1), f"2025-05-{1 + i // 1440:02d}T{i // 60 % 24:02d}:{i % 60:02d}"))
    newest = {}
    for name, hour, temp, snap in rows:
        if (name, hour) not in newest or snap > newest[name, hour][0]:
            newest[name, hour] = (snap, temp)
    got = {
        (r["name"], r["time"].strftime("%Y-%m-%dT%H:%M")): r["temperature_2m"]
        for r in latest_readings(micro.stamped(spark, rows)).collect()
    }
    assert got == {k: v[1] for k, v in newest.items()}

    groups = defaultdict(list)
    for (name, hour), (_, temp) in newest.items():
        groups[name, hour[:10]].append(temp)
    daily = by_key(daily_weather(micro.stamped(spark, rows), dedupe="latest"))
    assert daily.keys() == groups.keys()
    for key, temps in groups.items():
        avg, low, high = daily[key]
        assert avg == pytest.approx(sum(temps) / len(temps))
        assert (low, high) == (min(temps), max(temps))
        assert low <= avg <= high
