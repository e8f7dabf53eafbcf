import micro
from thermopolis.operators import serving


def test_history_is_the_latest_days_of_that_city_and_year(spark):
    rows = [{"city": "O'Brien", "date": f"2025-05-{d:02d}"} for d in range(1, 32)]
    rows += [{"city": "O'Brien", "date": "2024-01-01", "year": 2024}, {"city": "Other"}]
    got = serving.city_history(micro.trusted(spark, rows), "O'Brien", 2025, 30).collect()
    assert [r["date"] for r in got] == [f"2025-05-{d:02d}" for d in range(31, 1, -1)]
    assert {r["city"] for r in got} == {"O'Brien"}
    assert got[0].asDict().keys() == {
        "city",
        "date",
        "avg_temperature",
        "min_temperature",
        "max_temperature",
        "water_m3",
        "electricity_kwh",
        "population",
        "country",
    }


def test_unknown_city_is_empty_and_text_is_only_text(spark):
    df = micro.trusted(spark, [{}])
    assert serving.city_history(df, "' OR '1'='1", 2025).isEmpty()


def test_cities_of_a_year_once(spark):
    df = micro.trusted(
        spark, [{"date": "2025-05-27"}, {"date": "2025-05-28"}, {"city": "B", "year": 2024}]
    )
    assert [tuple(r) for r in serving.list_cities(df, 2025).collect()] == [("A", "X", 1.0, 2.0)]


def test_ties_by_city_and_unknown_last(spark):
    means = spark.createDataFrame(
        [("C", 1.0), ("B", 2.0), ("A", 1.0), ("D", None)], "city string, mean_temp double"
    )
    assert [r["city"] for r in serving.temperature_rankings(means).collect()] == ["B", "A", "C", "D"]
    averages = means.withColumnRenamed("mean_temp", "avg_kwh_per_person")
    assert [r["city"] for r in serving.consumption_rankings(averages).collect()] == ["B", "A", "C", "D"]


def test_correlation_of_a_constant_is_null(spark):
    rows = [{"avg_temperature": float(t), "electricity_kwh": 3.0 * t, "water_m3": 5.0} for t in range(5)]
    row = serving.correlations(micro.trusted(spark, rows), 2025).first()
    assert round(row["temp_electricity_corr"], 12) == 1.0
    assert row["temp_water_corr"] is None
    assert row["electricity_water_corr"] is None


def test_correlation_uses_rows_where_both_are_known(spark):
    rows = [
        {"avg_temperature": 1.0, "electricity_kwh": 2.0},
        {"avg_temperature": 2.0, "electricity_kwh": 4.0},
        {"avg_temperature": 3.0, "electricity_kwh": 6.0},
        {"avg_temperature": 100.0, "electricity_kwh": None},
        {"avg_temperature": None, "electricity_kwh": -50.0},
    ]
    row = serving.correlations(micro.trusted(spark, rows), 2025).first()
    assert round(row["temp_electricity_corr"], 12) == 1.0
