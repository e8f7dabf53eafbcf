"""Line deduplication relative to a site: lines that many pages of one host share are boilerplate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thermopolis.llm.common import materialize

#: A line is boilerplate of a host when more than this share of its pages hold it ...
MAX_RATIO = 0.05
#: ... and at least so many pages do, so that small hosts keep their lines.
MIN_PAGES = 5
#: What a white-space line consists of.
BLANK = " \t\n\v\f\r"
#: Boilerplate of all hosts up to so many bytes is broadcast to the pages; more is joined by a shuffle.
BROADCAST_BYTES = 16 << 20


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def boilerplate(
    docs: DataFrame,
    max_ratio: float = MAX_RATIO,
    min_pages: int = MIN_PAGES,
    host_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """(host, line, pages, host_pages): the lines whose share of their host's pages is too high.

    ``host`` is the host with "=" before it, "" for a NULL one. A page counts once for each line,
    however often it repeats it; white-space lines never count. Lines are first counted by a 64-bit
    hash, a sum that is combined before the shuffle; only lines whose hash is frequent are counted
    again as text, so two lines with one hash are told apart. A host of avg lines a page has at most
    avg / max_ratio such lines, whatever its size.
    """
    host = F.coalesce(F.concat(F.lit("="), F.col(host_col).cast("string")), F.lit(""))
    pages = docs.select(host.alias("host"), F.col(text_col).alias("text"))
    totals = pages.groupBy("host").agg(F.count(F.lit(1)).alias("host_pages"))
    lines = pages.select("host", F.explode(F.array_distinct(_lines(F.col("text")))).alias("line"))
    lines = lines.where(F.length(F.btrim("line", F.lit(BLANK))) > 0).withColumn("hash", F.xxhash64("line"))
    frequent = (F.col("pages") >= min_pages) & (F.col("pages") > max_ratio * F.col("host_pages"))
    suspects = lines.groupBy("host", "hash").agg(F.count(F.lit(1)).alias("pages")).where(F.col("pages") >= min_pages)
    suspects = suspects.join(totals, "host").where(frequent).select("host", "hash", "host_pages")
    counted = lines.join(suspects, ["host", "hash"]).groupBy("host", "line", "host_pages")
    return counted.agg(F.count(F.lit(1)).alias("pages")).where(frequent).select("host", "line", "pages", "host_pages")


def drop_boilerplate(
    docs: DataFrame,
    max_ratio: float = MAX_RATIO,
    min_pages: int = MIN_PAGES,
    host_col: str = "source",
    text_col: str = "text",
    counts: bool = True,
) -> DataFrame:
    """``docs`` without boilerplate lines, with ``n_lines`` (before) and ``n_dropped`` added at the end
    unless ``counts`` is off.

    The text's other lines stay byte for byte and in order. Each host's few lines are found first; if those
    of all hosts are small they are broadcast, so that no text is shuffled, and beyond that Spark
    splits a hot host's pages.

    Defined results: a NULL text stays NULL with no lines, an empty one has one empty line; lines of
    white space, carriage returns too, never go; pages with a NULL host are pages of one host; repeated
    rows count as pages of their own and all stay; a page of boilerplate alone becomes an empty text;
    other columns pass unchanged, but an ``n_lines`` or ``n_dropped`` that is there gives way to the new one.
    """
    found = materialize(boilerplate(docs, max_ratio, min_pages, host_col, text_col).select("host", "line"))
    n, size = found.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("line")), F.lit(0))).first()
    taken = {c.lower() for c in docs.columns}
    host_name, lines_name = (_fresh(name, taken) for name in ("host", "lines"))
    by_host = found.groupBy(F.col("host").alias(host_name)).agg(F.collect_list("line").alias(lines_name))
    if 100 * n + size <= BROADCAST_BYTES:
        by_host = F.broadcast(by_host)
    host = F.coalesce(F.concat(F.lit("="), docs[host_col].cast("string")), F.lit(""))
    text = F.col(f"`{text_col}`")
    kept = F.filter(_lines(text), lambda line: ~F.array_contains(lines_name, line))
    before = F.coalesce(F.size(_lines(text)), F.lit(0))
    edited = F.col(lines_name).isNotNull() & text.isNotNull()
    joined = docs.withColumn(host_name, host).join(by_host, host_name, "left")
    passed = [c for c in docs.columns if not (counts and c.lower() in ("n_lines", "n_dropped"))]
    return joined.select(
        *[F.when(edited, F.array_join(kept, "\n")).otherwise(text).alias(c) if c == text_col else F.col(f"`{c}`") for c in passed],
        *[
            F.when(text.isNull(), 0).otherwise(before).cast("int").alias("n_lines"),
            F.when(edited, before - F.size(kept)).otherwise(0).cast("int").alias("n_dropped"),
        ]
        * counts,
    )


def _fresh(name: str, taken: set[str]) -> str:
    """A column name that is not taken."""
    while name in taken:
        name = f"{name}_"
    return name
