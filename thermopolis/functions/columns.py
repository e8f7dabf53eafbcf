"""Column expressions shared by the operators. All stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY = "yyyy-MM-dd"
SNAPSHOT = "yyyy-MM-dd'T'HH-mm-ss'Z'"
PAYLOAD_TIME = "yyyy-MM-dd'T'HH:mm"

# Two hex digits of an MD5 are 256 values; those below 'cd' are 205 of them, 80 %.
TRAIN_BELOW = "cd"


def per_capita(amount: str, population: str = "population") -> Column:
    """NULL, not an ANSI error, where nobody is counted."""
    return F.col(amount) / F.nullif(F.col(population), F.lit(0))


def city_slug(name: str) -> Column:
    return F.lower(F.replace(F.col(name), F.lit(" "), F.lit("_")))


def snapshot_label(instant: str) -> Column:
    return F.date_format(F.col(instant), SNAPSHOT)


def snapshot_from_file_name(file_name: Column) -> Column:
    """Fetch instant out of ``<slug>_<stamp>.csv``; NULL for other names."""
    stamp = F.regexp_extract(file_name, r"_(\d{4}-\d\d-\d\dT\d\d-\d\d-\d\dZ)\.csv$", 1)
    return F.try_to_timestamp(stamp, F.lit(SNAPSHOT))


def is_train(*keys: str) -> Column:
    """Hash split that depends on the row only, so any cluster layout splits alike."""
    return F.substring(F.md5(F.concat_ws("|", *keys)), 1, 2) < F.lit(TRAIN_BELOW)


def pearson(x: str, y: str) -> Column:
    """Correlation over rows where both are known; NULL where either one is constant.

    The built-in ``corr`` divides by zero on a constant column under ANSI.
    """
    x_known = F.when(F.col(y).isNotNull(), F.col(x))
    y_known = F.when(F.col(x).isNotNull(), F.col(y))
    spread = F.stddev_pop(x_known) * F.stddev_pop(y_known)
    return F.covar_pop(x, y) / F.nullif(spread, F.lit(0.0))
