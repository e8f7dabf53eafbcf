"""What hourly runs keep between them: the parts of each fetch day, and the days merged out of them.

Two tables of one versioned folder. ``parts`` has the partial days of every fetch day, ``days`` the daily
rows; the notes say of each fetch day which files it was computed from, how many readings they
held and which days those are of. A fetch day whose files have changed is computed anew and replaces
its part, so a run that is repeated, or broken off and repeated, adds nothing twice.
"""

from __future__ import annotations

import hashlib
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from thermopolis import schemas
from thermopolis.operators.daily import merge_days, partial_days
from thermopolis.sources import versions
from thermopolis.sources.versions import Draft, Files

PARTS, DAYS = "parts", "days"
#: The partition of rows without a day, and the raw zone's name of it.
NO_DAY = "none"
RAW_NO_DAY = "__HIVE_DEFAULT_PARTITION__"
FETCH = "snapshot_date"
#: A folder changed so many seconds ago may change again without its time showing it.
SETTLED_SECONDS = 2


@dataclass
class Changes:
    """What a run has to look at: fetch days with their folders' state, and those that are gone."""

    new: dict[str, dict]
    gone: list[str]


def fingerprint(files: list[tuple[str, int, float]]) -> str:
    """A digest of names, sizes and times of the files of a folder."""
    shown = sorted(x for x in files if not x[0].startswith(("_", ".")))
    return hashlib.sha256(repr(shown).encode()).hexdigest()


def folder_fingerprint(spark: SparkSession, base: str) -> str:
    """Changes when what a zone publishes, or the files of a plain folder and of its folders, do."""
    version = versions.latest(spark, base)
    if version is not None:
        return f"version {version.number}"
    files = Files(spark, base)
    found = files.list()
    return fingerprint(found + [(f"{n}/{x}", s, t) for n, _, _ in found for x, s, t in files.list(n) if n != x])


def changes(spark: SparkSession, readings: str, known: dict[str, dict]) -> Changes:
    """Fetch days of the raw zone whose files are not those that ``known`` was computed from. Folder times
    that say nothing new are entered in ``known``.

    The files of a day are listed only if its folder has another time than before; on stores whose
    folders have no time of their own that is always so, and only costs the listing.
    """
    files, new, seen = Files(spark, readings), {}, set()
    for name, _, changed in files.list():
        if not name.startswith(f"{FETCH}="):
            continue
        day = name.removeprefix(f"{FETCH}=")
        day = NO_DAY if day == RAW_NO_DAY else day
        seen.add(day)
        old = known.get(day, {})
        if changed == old.get("changed"):
            continue
        state = {"files": fingerprint(files.list(name)), "changed": changed if time.time() - changed > SETTLED_SECONDS else 0}
        if state["files"] != old.get("files"):
            new[day] = state
        else:
            old["changed"] = state["changed"]
    return Changes(new, sorted(known.keys() - seen))


def compute_parts(spark: SparkSession, readings: str, found: Changes, dedupe: str) -> DataFrame:
    """Partial days of the changed fetch days; no other folder of the raw zone is listed or read."""
    names = [RAW_NO_DAY if day == NO_DAY else day for day in found.new]
    paths = [f"{readings}/{FETCH}={name}" for name in names]
    schema = StructType([*schemas.STAMPED_READINGS.fields, StructField(FETCH, DateType())])
    rows = spark.read.schema(schema).option("basePath", readings).parquet(*paths)
    return partial_days(rows, dedupe, FETCH)


def write(rows: DataFrame, root: str, draft: Draft, table: str, column: str) -> list[str]:
    """Write a table's rows beside its others, a folder for each day in ``column``; the days."""
    spark = rows.sparkSession
    part = F.coalesce(F.col(column).cast("string"), F.lit(NO_DAY))
    folder = f"{draft.folder}/{table}"
    rows.withColumn("part", part).hint("rebalance", "part").write.partitionBy("part").parquet(f"{root}/{folder}")
    days = [name.removeprefix("part=") for name in versions.partitions(spark, root, folder)]
    for day in days:
        draft.tables.setdefault(table, {})[day] = f"{folder}/part={day}"
    return days


def read(spark: SparkSession, root: str, tables: dict[str, dict[str, str]], table: str, schema, days: set[str] | None = None) -> DataFrame:
    """Rows of a table, of some ``days`` or all, in one scan however many runs have written them."""
    paths = [f"{root}/{place}" for day, place in sorted(tables.get(table, {}).items()) if days is None or day in days]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)


def touched(parts: DataFrame) -> dict[str, dict]:
    """Of each fetch day the readings it has and the days those are of: as many rows as there are days."""
    day = F.coalesce(F.col("day").cast("string"), F.lit(NO_DAY))
    fetch = F.coalesce(F.col(FETCH).cast("string"), F.lit(NO_DAY))
    found = parts.groupBy(fetch.alias("fetch"), day.alias("day")).agg(F.sum("n_rows").alias("n_rows")).collect()
    out: dict[str, dict] = {}
    for row in found:
        entry = out.setdefault(row["fetch"], {"rows": 0, "days": []})
        entry["rows"] += row["n_rows"]
        entry["days"].append(row["day"])
    return out


def advance(spark: SparkSession, root: str, draft: Draft, readings: str, found: Changes, dedupe: str) -> set[str]:
    """Enter new parts and the days merged out of them into ``draft``; returns the days computed anew."""
    notes = draft.notes.setdefault("fetches", {})
    old = {day: notes[day] for day in [*found.new, *found.gone] if day in notes}
    affected = {d for entry in old.values() for d in entry["days"]}
    for day in old:
        draft.tables.get(PARTS, {}).pop(day, None)
        del notes[day]
    if found.new:
        parts = compute_parts(spark, readings, found, dedupe)
        write(parts, root, draft, PARTS, FETCH)
        written = read(spark, root, draft.tables, PARTS, parts.schema, set(found.new))
        new = touched(written)
        for day, state in found.new.items():
            notes[day] = state | new.get(day, {"rows": 0, "days": []})
            affected |= set(notes[day]["days"])
    if not affected:
        return affected
    # Only fetch days that hold readings of these days are read again.
    sources = {day for day, entry in notes.items() if not affected.isdisjoint(entry["days"])}
    parts = read(spark, root, draft.tables, PARTS, parts_schema(dedupe), sources)
    dated = [d for d in affected if d != NO_DAY]
    wanted = F.col("day").isin([F.lit(d).cast("date") for d in dated]) if dated else F.lit(False)
    if NO_DAY in affected:
        wanted = wanted | F.col("day").isNull()
    for day in affected:
        draft.tables.get(DAYS, {}).pop(day, None)
    write(merge_days(parts.where(wanted), dedupe), root, draft, DAYS, "date")
    return affected


def parts_schema(dedupe: str) -> str:
    kept = f"{FETCH} date, name string, day date"
    if dedupe == "latest":
        return f"{kept}, time timestamp, n_rows bigint, newest struct<snapshot: timestamp, temperature_2m: double>"
    return f"{kept}, n_rows bigint, n bigint, total decimal(38,18), beyond double, least double, greatest double"


#: The daily rows as stored.
DAILY = "name string, date string, avg_temperature double, min_temperature double, max_temperature double"
