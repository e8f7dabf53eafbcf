import pytest

import micro
from thermopolis.operators import integrate, metrics, quality, serving
from thermopolis.operators.daily import daily_weather


def test_defaults_for_missing_facts(spark):
    rows = micro.info(
        spark,
        cities=[(1, "Bare", 1.5, 2.5), (2, "Full", 3.5, 4.5)],
        regions=[(7, "Land")],
        city_region=[(2, 7)],
        population=[(2, 2025, 50)],
        city_consumption=[(1, 2, 2025, 10.0, 100.0)],
    ).collect()
    assert {tuple(r) for r in rows} == {
        ("Bare", 1.5, 2.5, 0.0, 0.0, 0, None, "Unknown"),
        ("Full", 3.5, 4.5, 10.0, 100.0, 50, 2025, "Land"),
    }


def test_years_match_unless_told_otherwise(spark):
    tables = {
        "cities": [(1, "A", 0.0, 0.0)],
        "population": [(1, 2024, 10), (1, 2025, 20)],
        "city_consumption": [(1, 1, 2024, 1.0, 2.0), (2, 1, 2025, 3.0, 4.0)],
    }
    matched = micro.info(spark, **tables).collect()
    assert {(r["year"], r["population"]) for r in matched} == {(2024, 10), (2025, 20)}
    crossed = micro.info(spark, match_year=False, **tables).collect()
    assert sorted((r["year"], r["population"]) for r in crossed) == [
        (2024, 10),
        (2024, 20),
        (2025, 10),
        (2025, 20),
    ]


def test_population_without_consumption_by_city_alone(spark):
    row = micro.info(
        spark, match_year=False, cities=[(1, "A", 0.0, 0.0)], population=[(1, 2025, 9)]
    ).first()
    assert (row["population"], row["year"], row["electricity_kwh"]) == (9, None, 0.0)


def test_names_join_exactly_and_the_rest_is_reported(spark):
    hours = micro.readings(
        spark,
        [
            ("Medellín", "2025-05-27T00:00", 20.0),
            ("Quito", "2025-05-27T00:00", 15.0),
            ("quito", "2025-05-27T00:00", 15.0),
            (None, "2025-05-27T00:00", 1.0),
        ],
    )
    tables = micro.dimensions(
        spark,
        cities=[(1, "Medellin", 0.0, 0.0), (2, "Quito", 0.0, 0.0)],
        city_consumption=[(1, 2, 2025, 1.0, 2.0), (2, 2, 2024, 1.0, 2.0)],
    )
    info = integrate.city_info(**tables)
    kept = integrate.trusted(daily_weather(hours), info).collect()
    assert sorted((r["city"], r["year"]) for r in kept) == [("Quito", 2024), ("Quito", 2025)]
    missed = quality.unmatched_names(hours, tables["cities"]).collect()
    assert {(r["name"], r["side"]) for r in missed} == {
        ("Medellín", "readings"),
        ("quito", "readings"),
        (None, "readings"),
        ("Medellin", "cities"),
    }
    counts = {r["stage"]: r["n_rows"] for r in quality.stage_counts(hours, info).collect()}
    assert counts == {"readings": 4, "daily": 4, "city_info": 3, "final": 2}


def test_stage_counts_of_nothing(spark):
    counts = quality.stage_counts(micro.readings(spark, []), micro.info(spark)).collect()
    assert {r["n_rows"] for r in counts} == {0}


def test_per_capita_is_null_where_nobody_is_counted(spark):
    df = metrics.derive_metrics(micro.trusted(spark, [{"population": 0}, {"population": 4}]))
    got = {r["population"]: (r["kwh_per_capita"], r["water_per_capita"]) for r in df.collect()}
    assert got == {0: (None, None), 4: (25.0, 2.5)}
    row = df.first()
    assert (row["temp_range"], row["temp_squared"]) == (10.0, 400.0)


def test_bad_text_becomes_null(spark):
    text = micro.trusted(spark, [{}])
    text = text.select(*[text[c].cast("string").alias(c) for c in text.columns])
    bad = text.withColumn("population", text["city"]).withColumn("water_m3", text["country"])
    row = metrics.typed_trusted(bad).first()
    assert (row["population"], row["water_m3"], row["electricity_kwh"]) == (None, None, 100.0)


def test_mean_of_daily_means(spark):
    hours = [("A", "2025-05-27T00:00", 10.0)] + [("A", f"2025-05-28T0{h}:00", 40.0) for h in range(9)]
    daily = daily_weather(micro.readings(spark, hours)).withColumnRenamed("name", "city")
    assert metrics.temperature_per_city(daily).first()["mean_temp"] == 25.0


def test_published_ranking(spark):
    """Rows of static tables whose published ranking is known."""
    cities = [
        (1, "New York", 40.7128, -74.006),
        (8, "Toronto", 43.651, -79.347),
        (96, "Thompson", 55.7435, -97.8558),
        (98, "Moose Jaw", 50.3917, -105.5347),
        (99, "North Battleford", 52.7894, -108.2967),
        (100, "Estevan", 49.1392, -102.9916),
    ]
    kwh = {1: 7400.0, 8: 6800.0, 96: 4700.0, 98: 4900.0, 99: 4700.0, 100: 4900.0}
    people = {1: 8097282, 8: 6431000, 96: 13000, 98: 33000, 99: 14000, 100: 11000}
    info = micro.info(
        spark,
        cities=cities,
        population=[(i, 2025, n) for i, n in people.items()],
        city_consumption=[(i, i, 2025, 1.0, v) for i, v in kwh.items()],
    )
    hours = [(c[1], f"2025-05-{d}T00:00", 20.0) for c in cities for d in (27, 28, 29)]
    trusted = integrate.trusted(daily_weather(micro.readings(spark, hours)), info)
    ranked = serving.consumption_rankings(metrics.consumption_per_city(trusted)).collect()
    assert [r["city"] for r in ranked] == [
        "Estevan",
        "Thompson",
        "North Battleford",
        "Moose Jaw",
        "Toronto",
        "New York",
    ]
    expected = [
        0.4454545454545454,
        0.36153846153846153,
        0.33571428571428574,
        0.14848484848484847,
        0.001057378323744363,
        9.13886906742287e-4,
    ]
    assert [r["avg_kwh_per_person"] for r in ranked] == pytest.approx(expected, abs=1e-12)


def test_features_keep_coordinates(spark):
    df = micro.trusted(
        spark,
        [
            {"date": "2025-05-27", "avg_temperature": 10.0, "population": 0},
            {"date": "2025-05-28", "avg_temperature": 30.0},
        ],
    )
    row = metrics.city_features(metrics.derive_metrics(df)).first()
    assert row.asDict() == {
        "city": "A",
        "avg_temp": 20.0,
        "avg_kwh_per_capita": 20.0,
        "avg_water_per_capita": 2.0,
        "avg_temp_range": 10.0,
        "latitude": 1.0,
        "longitude": 2.0,
    }
