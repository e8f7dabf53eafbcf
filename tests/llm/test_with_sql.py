"""Queries with SQL give the same rows and types in both engines; edge cases of their operators."""

import hashlib

import pytest
from compare import duckdb_rows, spark_rows
from pyspark.sql import functions as F

from thermopolis.llm import decontaminate, lines, vectors, warc
from thermopolis.llm.common import scratch
from thermopolis.llm.queries import ORACLES, QUERIES

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, con, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    assert {c: TYPES[t] for c, t in df.dtypes} == {d[0]: str(d[1]) for d in con.execute(f"DESCRIBE {ORACLES[name]}").fetchall()}
    assert spark_rows(df) == duckdb_rows(con, ORACLES[name])


def test_lines_edges(odd, empty):
    rows = lines.drop_boilerplate(odd, max_ratio=0.1, min_pages=2).collect()
    assert len(rows) == odd.count() and rows[0].__fields__[:3] == ["doc_id", "text", "source"]
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert (by_id[0].text, by_id[0].n_lines, by_id[0].n_dropped) == (None, 0, 0)
    assert (by_id[1].text, by_id[1].n_lines, by_id[1].n_dropped) == ("", 1, 0)
    assert (by_id[4].text, by_id[4].n_dropped) == ("", 1)  # two rows of host b
    assert by_id[3].n_dropped == 0 and by_id[2].text == " \t\n "
    assert lines.drop_boilerplate(empty).collect() == []


def test_a_line_counts_once_a_page(spark):
    docs = spark.createDataFrame([(1, "a\na\na", "h"), (2, "b", "h"), (3, "c\na", "h")], "doc_id long, text string, source string")
    rows = {r.doc_id: (r.text, r.n_dropped) for r in lines.drop_boilerplate(docs, 0.5, 2).collect()}
    assert rows == {1: ("", 3), 2: ("b", 0), 3: ("c", 1)}


def test_white_space_lines_stay(spark):
    docs = spark.createDataFrame([(i, f"a{i}\r\n\r\nb{i}\n\t\nsame\n \v\f", "h") for i in range(6)], "doc_id long, text string, source string")
    rows = lines.drop_boilerplate(docs, 0.5, 2).collect()
    assert {r.text for r in rows} == {f"a{i}\r\n\r\nb{i}\n\t\n \v\f" for i in range(6)}


def test_names_of_the_operator_s_own_are_free(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "same\nx", "h") for i in range(6)], "doc_id long, text string, source string")
    names = ["__host", "__lines", "host", "Lines", "n_lines", "N_DROPPED", "host_"]
    docs = docs.select("*", *[F.lit("x").alias(n) for n in names])
    for bound in (lines.BROADCAST_BYTES, 0):
        monkeypatch.setattr(lines, "BROADCAST_BYTES", bound)
        found = lines.drop_boilerplate(docs, 0.5, 2)
        assert found.columns == ["doc_id", "text", "source", "__host", "__lines", "host", "Lines", "host_", "n_lines", "n_dropped"]
        assert {tuple(r)[1:] for r in found.collect()} == {("", "h", *"xxxxx", 2, 2)}
    assert lines.drop_boilerplate(docs, 0.5, 2, counts=False).columns == docs.columns


def test_warc_round_trip(spark):
    pages = [
        (3, "http://a.example/x", "<p>é\r\n\r\nWARC/1.1\r\nx</p>"),
        (1, "http://b.example/ü v\r\nEvil: yes", "<p>é\r\n\r\nWARC/1.1\r\nx</p>"),
        (2, None, ""),
        (7, "", None),
        (8, "http://c.example/", "long " * 100_000),
        (None, "http://d.example/", ""),
        (None, "http://e.example/", "alone"),
        (8, "http://c.example/", "long " * 100_000),
    ]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    folder = scratch(spark, "warc-test")
    warc.write_archive(frame, folder)
    records = warc.read_archive(spark, folder)
    stored = records.where("record_type = 'response'").collect()
    assert len(stored) == 5  # one for each payload, and the repeated row
    rows = warc.restore(records).collect()
    got = sorted((r.page_id or -1, r.url or "", bytes(r.payload)) for r in rows)
    assert got == sorted((i or -1, u or "", (h or "").encode()) for i, u, h in pages)
    assert {(r.page_id, r.record_type, r.refers_to) for r in rows} == {
        (1, "response", None), (3, "revisit", 1), (2, "response", None), (7, "revisit", 2), (8, "response", None),
        (None, "revisit", 2), (None, "response", None),
    }
    assert all(r.headers.startswith("WARC/1.1\r\nWARC-Type: ") for r in rows)
    sha = {r.page_id: r.sha256 for r in rows}
    assert sha[2] == hashlib.sha256(b"").hexdigest()
    nothing = scratch(spark, "warc-empty")
    warc.write_archive(frame.limit(0), nothing)
    assert warc.restore(warc.read_archive(spark, nothing)).collect() == []


def test_leaks_edges(spark, odd, empty):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    bench = spark.createDataFrame(
        [(1, item), (1, item), (2, None), (3, "  "), (4, "short item"), (5, " ".join(["rep"] * 12)), (None, item)], "item_id long, text string"
    )
    docs = [
        (1, f"before that {item.upper()} and behind"),
        (2, item.replace("seven", "7")),
        (3, "a Short\nitem is here"),
        (4, "rep " * 40),
        (5, None),
        (6, ""),
        (7, item + " " + item),
        (7, item + " " + item),
        (None, item),
        (8, "one two three four five six seven eight nine ten eleven twelve thirteen"),
    ]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
    rows = decontaminate.find_leaks(frame, bench.where("item_id is not null")).collect()
    got = {(r.doc_id, r.item_id): (round(r.similarity, 3), r.start) for r in rows}
    assert got == {
        (1, 1): (1.0, 2), (3, 4): (1.0, 1), (4, 5): (1.0, 0), (7, 1): (1.0, 0), (None, 1): (1.0, 0), (8, 1): (0.9, 0),
    }
    assert decontaminate.find_leaks(odd, bench).columns == ["doc_id", "item_id", "similarity", "start", "distance"]
    assert decontaminate.find_leaks(empty, bench).collect() == []
    assert decontaminate.find_leaks(frame, bench.limit(0)).collect() == []


def test_leaks_run_without_python(spark, sf_dir):
    from thermopolis.llm.queries import table

    docs = table(spark, sf_dir, "documents").select("text")
    plan = docs.select(decontaminate.fingerprint(decontaminate.shingles(decontaminate.words(docs.text), decontaminate.F.lit(5)).cast("array<string>")))
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()


def test_vectors_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.01], 1), (4, [1.0, 0.0], 2), (5, [1.0, 0.0], None), (6, [0.0, 0.0], 1),
        (7, None, 1), (8, [nan, 1.0], 1), (9, [inf, 1.0], 1), (10, [None, 1.0], 1), (11, [], 1), (12, [1.0, 0.0, 0.0], 1),
        (None, [1.0, 0.0], 1), (13, [1.0, 0.0], 1), (13, [1.0, 0.0], 1), (14, [-1.0, 0.0], 1), (15, [1e300, 1e300], 3), (16, [1e-300, 1e-300], 3),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    got = vectors.near_duplicates(frame).collect()
    assert len(got) == len(rows)
    assert {(r.vec_id, r.n_links, r.component_id, r.kept) for r in got} == {
        (1, 4, 1, True), (2, 4, 1, False), (3, 4, 1, False), (13, 4, 1, False), (15, 1, 15, True), (16, 1, 15, False),
        (None, 0, None, True), *((i, 0, i, True) for i in (4, 5, 6, 7, 8, 9, 10, 11, 12, 14)),
    }
    assert vectors.near_duplicates(frame.limit(0)).collect() == []


def test_vector_recall_across_partitions(spark, monkeypatch):
    import numpy as np

    rng = np.random.default_rng(5)
    centres = rng.standard_normal((300, 32))
    x = np.concatenate([centres + 0.18 * rng.standard_normal(centres.shape) for _ in range(4)])
    monkeypatch.setattr(vectors, "PARTITION_ROWS", 500)
    frame = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    degree = (u @ u.T >= 0.93).sum(axis=1) - 1
    got = {r.vec_id: r.n_links for r in vectors.near_duplicates(frame).collect()}
    assert all(got[i] <= n for i, n in enumerate(degree.tolist()))
    assert sum(got.values()) >= 0.95 * degree.sum() > 0


def test_every_link_of_a_large_group_counts(spark):
    import numpy as np

    rng = np.random.default_rng(8)
    group = rng.standard_normal(16) + 0.05 * rng.standard_normal((6000, 16))
    pair = rng.standard_normal((600, 16))
    x = np.concatenate([group, pair, pair + 0.3 * rng.standard_normal(pair.shape)])
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = u @ u.T >= 0.93
    schema = "vec_id long, embedding array<double>, label int"
    frame = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], schema).repartition(3)
    got = {r.vec_id: r for r in vectors.near_duplicates(frame).collect()}
    assert near.sum(axis=1).max() >= 6000
    assert [got[i].n_links for i in range(len(x))] == (near.sum(axis=1) - 1).tolist()
    least = np.arange(len(x))
    while (new := np.array([least[row].min() for row in near])).tolist() != least.tolist():
        least = new
    assert [got[i].component_id for i in range(len(x))] == least.tolist()


def test_links_by_group_size_and_near_the_bound(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    pair = rng.standard_normal((500, 32))
    parts = {
        3000: rng.standard_normal(32) + 0.05 * rng.standard_normal((3000, 32)),
        30: np.concatenate([c + 0.1 * rng.standard_normal((30, 32)) for c in rng.standard_normal((20, 32))]),
        2: np.concatenate([pair, pair + 0.29 * rng.standard_normal(pair.shape)]),
    }
    x = np.concatenate(list(parts.values()))
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    wanted = (u @ u.T >= 0.93).sum(axis=1) - 1
    frame = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int").repartition(3)
    rows = {r.vec_id: r.n_links for r in vectors.near_duplicates(frame).collect()}
    got, at = np.array([rows[i] for i in range(len(x))]), 0
    assert (got <= wanted).all()
    for size, part in parts.items():
        mine = slice(at, at + len(part))
        assert got[mine].sum() >= (1.0 if size > 2 else 0.95) * wanted[mine].sum() > 0
        at += len(part)
    cosine = np.einsum("ij,ij->i", u[-1000:-500], u[-500:])
    near = (cosine >= 0.93) & (cosine < 0.94)
    assert near.sum() > 20 and (got[-1000:-500][near] > 0).mean() >= 0.9
