"""Small hand-made tables for cases the driver's tables do not reach."""

from datetime import datetime

from thermopolis import schemas
from thermopolis.operators.integrate import city_info


def at(text):
    return datetime.strptime(text, "%Y-%m-%dT%H:%M")


def readings(spark, rows):
    """rows of (name, time text, temperature)"""
    return spark.createDataFrame([(at(t), temp, name) for name, t, temp in rows], schemas.READINGS)


def stamped(spark, rows):
    """rows of (name, time text, temperature, snapshot text)"""
    return spark.createDataFrame(
        [(at(t), temp, name, at(s)) for name, t, temp, s in rows], schemas.STAMPED_READINGS
    )


def dimensions(spark, cities=(), regions=(), city_region=(), population=(), city_consumption=()):
    given = {
        "cities": cities,
        "regions": regions,
        "city_region": city_region,
        "population": population,
        "city_consumption": city_consumption,
    }
    return {
        name: spark.createDataFrame(list(rows), schemas.DIMENSIONS[name])
        for name, rows in given.items()
    }


def info(spark, match_year=True, **tables):
    return city_info(**dimensions(spark, **tables), match_year=match_year)


def trusted(spark, rows):
    """rows of dicts; what is left out is a default"""
    base = {
        "city": "A",
        "date": "2025-05-27",
        "avg_temperature": 20.0,
        "min_temperature": 15.0,
        "max_temperature": 25.0,
        "latitude": 1.0,
        "longitude": 2.0,
        "water_m3": 10.0,
        "electricity_kwh": 100.0,
        "population": 5,
        "country": "X",
        "year": 2025,
    }
    full = [{**base, **row} for row in rows]
    return spark.createDataFrame(
        [tuple(r[name] for name in schemas.TRUSTED.names) for r in full], schemas.TRUSTED
    )
