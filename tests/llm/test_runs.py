"""Periodic runs and the structures beneath them against brute force."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from thermopolis.llm import periodic
from thermopolis.llm.queries import QUERIES
from thermopolis.llm.wordsuffixes import suffix_array


def slow_runs(words):
    found, n = {}, len(words)
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(24, 3 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((a, b - a, q) for (a, b), q in found.items())


def random_words(rng):
    letters = rng.choice([1, 2, 3, 10])

    def piece(depth):
        if depth == 0 or rng.random() < 0.3:
            return [rng.randrange(letters) for _ in range(rng.randrange(1, 12))]
        x = piece(depth - 1)
        if rng.random() < 0.6:
            x = x * rng.randrange(2, 9)
            x = x + x[: rng.randrange(len(x))]
        if rng.random() < 0.3:
            x = x + piece(depth - 1)
        if rng.random() < 0.2:
            x[rng.randrange(len(x))] = rng.randrange(letters + 1)
        return x[:300]

    return piece(rng.randrange(1, 5))


@pytest.mark.parametrize("rounds", [0, 1, 16])
def test_runs_are_brute_force(rounds, monkeypatch):
    monkeypatch.setattr(periodic, "ROUNDS", rounds)
    rng, total = random.Random(rounds), 0
    for _ in range(60):
        texts = [random_words(rng) for _ in range(rng.randrange(1, 5))] + [[]]
        bounds = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
        want = [(int(low) + a, n, q) for low, t in zip(bounds, texts, strict=False) for a, n, q in slow_runs(t)]
        got = periodic.find_runs(np.array(sum(texts, []), np.int32), bounds)
        assert [tuple(r) for r in got.tolist()] == sorted(want, key=lambda r: (r[0], r[2]))
        total += len(want)
    assert total > 50


def test_range_successor():
    rng = np.random.default_rng(3)
    for size in (1, 2, 63, 64, 65, 500):
        values = rng.permutation(2 * size)[:size]
        matrix = periodic.WaveletMatrix(values)
        left, right = np.sort(rng.integers(0, size + 1, (2, 200)), axis=0)
        x = rng.integers(0, 2 * size + 3, 200)
        want = [min((v for v in values[a:b].tolist() if v >= y), default=-1) for a, b, y in zip(left, right, x, strict=True)]
        assert matrix.successor(left, right, x).tolist() == want


def test_suffix_array_keeps_equal_beginnings_together():
    words = np.array([0, 1, 0, 1, 1, 0, 1, 0, 1, 1] * 8, np.int32)
    ends = np.full(len(words), len(words))
    array, levels = suffix_array(words, ends, ends)
    for length, starts, left, right in levels:
        for s, a, b in zip(starts.tolist(), left.tolist(), right.tolist(), strict=True):
            same = [i for i in range(len(words) - length + 1) if words[i : i + length].tolist() == words[s : s + length].tolist()]
            assert sorted(array[a:b].tolist()) == same and len(same) > 1
    assert [x[0] for x in levels] == [8, 16, 32, 64]


def expected(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n > 0:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = sorted(slow_runs(words), key=lambda r: (r[0], r[2]))
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    return (
        doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
        hashlib.sha256("".join(f"{s},{x},{q}\n" for s, x, q in runs).encode()).hexdigest(),
        hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in dropped)).hexdigest(),
    )


def test_query_is_brute_force(spark, sf_dir, documents):
    df = QUERIES["op11_periodic_runs"](spark, sf_dir)
    assert df.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert [t for _, t in df.dtypes] == ["bigint"] * 6 + ["string"] * 2
    rows = {tuple(r) for r in df.collect()}
    texts = {i: t for i, t in documents.items() if len((t or "").split()) < 1500}
    assert len(rows) == len(documents) and len(texts) > 100
    assert {expected(i, t) for i, t in texts.items()} <= rows


def test_edges(spark, odd, empty):
    rows = periodic.periodic_runs(odd).collect()
    assert len(rows) == odd.count()
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    for i in (0, 1, 2):
        assert (by_id[i].n_words, by_id[i].runs, by_id[i].strongest, by_id[i].collapsed) == (0, [], None, "")
    assert by_id[5].collapsed == "Über naïve façade — 中文 😀 <|endoftext|> don't"
    assert tuple(by_id[6].strongest) == (0, 30_000, 1) and by_id[6].collapsed == "word"
    assert by_id[7].n_words == 1 and len(by_id[7].collapsed) == 70_000
    assert periodic.periodic_runs(empty).collect() == []
    # Runs of neighbouring rows are not one; equal exponents leave the first; several runs in a text.
    twice = spark.createDataFrame([(1, "a " * 23), (2, "a " * 23), (3, "b " * 24 + "c " + "d e " * 24 + "f " * 24)], "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r for r in periodic.periodic_runs(twice).collect()}
    assert got[1].runs == got[2].runs == []
    assert [tuple(r) for r in got[3].runs] == [(0, 24, 1), (25, 48, 2), (73, 24, 1)] and tuple(got[3].strongest) == (0, 24, 1)
    assert got[3].collapsed == "b c d e f"


def test_a_long_text_of_one_word_and_one_of_a_long_period():
    words = np.concatenate((np.zeros(200_000, np.int32), np.arange(70_000, dtype=np.int32) % 20_000 + 1))
    runs = periodic.find_runs(words, np.array([0, len(words)]))
    assert runs.tolist() == [[0, 200_000, 1], [200_000, 70_000, 20_000]]
