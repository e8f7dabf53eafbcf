"""Operators that SQL cannot state, against brute force, the library itself or held-out labels."""

import hashlib
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from thermopolis.llm import bpe, licenses, suffixes, tokens, toxicity
from thermopolis.llm.common import gathered
from thermopolis.llm.queries import QUERIES, held_out, table, word_bpe
from thermopolis.llm.words import BatchMerger, Merger, runs_in, runs_of


@pytest.fixture(scope="module")
def library():
    return tokens.load(word_bpe())


def by_id(rows):
    return {r.doc_id: r for r in rows if r.doc_id is not None}


def test_token_counts_are_the_library_s(spark, sf_dir, documents, library):
    rows = QUERIES["op6_token_counts"](spark, sf_dir).collect()
    want = {i: (len(t.encode()), len(library.encode(t, add_special_tokens=False).ids)) for i, t in documents.items()}
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in rows} == want
    assert all(r.over_limit == (r.n_tokens > 2048) for r in rows)


def test_bpe_is_the_library_s(spark, sf_dir, documents, library):
    rows = by_id(QUERIES["op9_bpe"](spark, sf_dir).collect())
    for i, text in documents.items():
        ids = library.encode(text, add_special_tokens=False).ids
        assert rows[i].n_tokens == len(ids)
        assert rows[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert rows[i].decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


TEXTS = [
    None, "", "  ", "<|endoftext|>a<|startoftext|> <|ENDOFTEXT|>", "don't we'll I'M 'SX ?'s 12½   x y", "İstanbul ΣΑΣ ﬁ é 中文字 😀",
    "a\x1cb \x85 z q", "<|endoftext", "a" * 300 + " " + "é" * 50, "tab\tnew\nline\r\x0b\x0cq", "� \u0000 x",
]


def test_odd_texts(spark, library, odd, empty):
    frame = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    encoded, counted = (by_id(x.collect()) for x in (bpe.encode_decode(frame, word_bpe()), tokens.count_tokens(frame, word_bpe())))
    for i, text in enumerate(TEXTS):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert (list(encoded[i].ids), encoded[i].decoded) == (ids, library.decode(ids, skip_special_tokens=False))
        assert (counted[i].n_tokens, counted[i].n_bytes) == (len(ids), len((text or "").encode()))
    assert tokens.count_tokens(odd, word_bpe()).count() == bpe.encode_decode(odd, word_bpe()).count() == odd.count()
    assert tokens.count_tokens(empty, word_bpe()).collect() == bpe.encode_decode(empty, word_bpe()).collect() == []


def test_long_texts_are_spliced(library, documents):
    longest = max(documents.values(), key=len)
    for text in [longest, "x" * 5000 + " y z " * 100, "ab<|endoftext|> " * 3000, "日本 " * 4000 + "q" * 3000, "a " * 1000]:
        want = len(library.encode(text, add_special_tokens=False).ids)
        assert all(tokens.count_long(library, text, c, o) == want for c, o in ((700, 50), (3000, 200), (200, 10)))


def test_the_transducer_is_minimal_and_exact():
    words = {f"{a}{b}ing".encode(): [len(a), len(b)] for a in ("", "un", "re", "over") for b in ("do", "see", "lay", "lock")}
    data = bpe.compile_words(words.items())
    look_up = bpe.Transducer(data)
    assert {w: look_up(w) for w in words} == words
    assert [look_up(w) for w in (b"", b"un", b"undoin", b"undoings", b"zzz", b"\xff")] == [None] * 6
    suffixes_of_states = len(look_up.first) - 1
    assert suffixes_of_states <= 25  # the shared ends stand there once; the trie would have 97 states
    assert bpe.Transducer(bpe.compile_words([]))(b"a") is None


def slow_cut(rows, length):
    seen, out = set(), {}
    for i, text in sorted(rows, key=lambda r: r[0]):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - length + 1):
            window = data[p : p + length]
            gone[p : p + length] |= window in seen
            seen.add(window)
        kept = bytes(np.frombuffer(data, np.uint8)[~gone])
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out[i] = (len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def test_suffix_query_is_brute_force(spark, sf_dir, documents):
    rows = QUERIES["op4_suffix_dedup"](spark, sf_dir).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows} == slow_cut(documents.items(), 100)


def test_suffixes_of_periodic_and_shared_texts(spark):
    random.seed(3)
    base = ["".join(random.choice("abcdeé \n") for _ in range(random.randint(50, 900))) for _ in range(8)]
    rows = [(0, None), (1, ""), (2, "a" * 500), (3, "ab" * 300), (4, "a" * 99), (5, "a" * 99), (6, "a" * 100), (7, "b" * 7000), (8, "abc" * 40)]
    for i in range(9, 90):
        parts = [random.choice(base)[random.randint(0, 40) : random.randint(60, 900)] + random.choice(["", "xyz", "é"]) for _ in range(3)]
        rows.append((i, "".join(parts)))
    rows += [(200, rows[20][1]), (201, rows[20][1])]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = suffixes.cut_repeats(frame).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == slow_cut(rows, 100)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got)


def test_suffix_edges(odd, empty):
    got = suffixes.cut_repeats(odd).collect()
    assert len(got) == odd.count()
    assert {(r.n_bytes, r.n_removed) for r in got if r.doc_id in (4, 0)} == {(58, 0), (0, 0)}
    assert by_id(got)[6].n_removed == 150_000 - 5  # windows overlap: all bytes after the first period
    assert suffixes.cut_repeats(empty).collect() == []


def test_longest_previous_factors():
    data = b"abracadabra_abracadabra_bra"
    got = suffixes.previous_factors(np.frombuffer(data, np.uint8).astype(int), 100).tolist()
    want = [max(n for n in range(len(data) - i + 1) if n == 0 or data.find(data[i : i + n], 0, i + n - 1) >= 0) for i in range(len(data))]
    assert got == want


def test_windows_with_an_earlier_copy_are_those_of_long_previous_factors():
    rng = np.random.default_rng(2)
    parts = [rng.integers(97, 100, 60).astype(np.uint8) for _ in range(4)]
    data = np.concatenate([parts[i] for i in rng.integers(0, 4, 30)])
    factors = suffixes.previous_factors(data.astype(int), 40)
    starts = np.arange(len(data) - 39)
    assert (suffixes.have_previous(data, starts, 40) == (factors[starts] >= 40)).all()


def test_toxicity_on_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.1"
    scored = QUERIES["op3_toxicity"](spark, sf_dir)
    rows = scored.join(table(spark, sf_dir, "labels"), "doc_id").where("held_out").collect()
    caught = sum(r.toxic and r.predicted for r in rows)
    assert caught >= 0.85 * sum(r.toxic for r in rows)
    assert sum(r.predicted and not r.toxic for r in rows) <= 0.01 * len(rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_held_out_is_crc32_mod_5(spark):
    from zlib import crc32

    rows = spark.range(300).select("id", held_out("id").alias("h")).collect()
    assert all(r.h == (crc32(str(r.id).encode()) % 5 == 0) for r in rows)


def test_nearest_examples_are_exact():
    rng = random.Random(1)
    idf = np.array([1 + rng.random() for _ in range(40)])
    pick = lambda: dict(sorted({rng.randrange(40): rng.randint(1, 4) for _ in range(rng.randint(1, 6))}.items()))
    examples = [(i, pick(), 1, rng.randint(0, 1)) for i in range(700)]
    index = toxicity.Index(examples, idf)
    dense = np.zeros((len(index.names), 40))
    lookup = {n: e for e, n in enumerate(index.names)}
    for name, found, _, _ in examples:
        if name in lookup:
            terms, weights = toxicity.unit(found, idf)
            dense[lookup[name], terms] = weights
    for _ in range(60):
        found = pick()
        terms, weights = toxicity.unit(found, idf)
        query = np.zeros(40)
        query[terms] = weights
        cosine = np.round(dense @ query, 12)
        got = index.nearest(found, 25)
        assert np.allclose([c for c, _ in got], np.sort(cosine[cosine > 0])[::-1][: len(got)], atol=1e-9)
        assert len(got) == min(25, int((cosine > 0).sum()))


def test_toxicity_edges(spark, odd, empty):
    labels = spark.createDataFrame([(3, 1), (4, 1), (4, None), (5, 0), (None, 1), (99, 1)], "doc_id long, toxic int")
    for known in (labels, labels.limit(0)):
        rows = toxicity.score(odd, known).collect()
        assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score(empty, labels).collect() == []
    assert toxicity.reject(odd, labels).columns == odd.columns


def test_every_license_line_is_found(spark, sf_dir, documents):
    lines = {
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
        "Released under the MIT License.": "MIT",
        "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    }
    want = sorted((i, name) for i, t in documents.items() for line, name in lines.items() for _ in range(t.count(line)))
    rows = QUERIES["op5_license_scan"](spark, sf_dir).collect()
    assert want and sorted((r.doc_id, r.license) for r in rows) == want


def test_license_wording(spark, odd, empty):
    mit = dict((len(t), (n, t)) for n, t in licenses.TEMPLATES if n == "MIT")
    text = mit[max(mit)][1]
    docs = [
        (1, "intro words\n" + text.replace("free of charge", "for a small fee").replace(", to ", ",\nto ") + "\nLicensed under CC BY 4.0.\nend"),
        (2, "the permission of a licensed driver is no license"),
        (3, ("filler words " * 3000) + "Released under the MIT License. " + "more filler " * 3000),
        (4, None),
    ]
    rows = licenses.scan_licenses(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    got = {(r.doc_id, r.license): r for r in rows}
    assert set(got) == {(1, "MIT"), (1, "CC-BY-4.0"), (3, "MIT")}
    assert got[1, "MIT"].missing == ["free", "of", "charge"] and got[1, "MIT"].added == ["for", "a", "small", "fee"]
    assert got[1, "CC-BY-4.0"].wording == 1.0
    assert licenses.scan_licenses(odd).collect() == licenses.scan_licenses(empty).collect() == []


def test_windows_of_crowded_minima_meet_apart(spark, monkeypatch):
    rng = random.Random(11)
    noise = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage, other = noise(160), noise(120)
    rows = [(i, noise(150) + passage + noise(150) + (other if i % 3 else other[:110] + passage[:130])) for i in range(300)]
    rows += [(400, "a" * 3000), (401, passage * 6 + noise(20) + passage), (402, None)]
    monkeypatch.setattr(suffixes, "CROWDED", 40)
    monkeypatch.setattr(suffixes, "PIECE", 4000)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = suffixes.cut_repeats(frame).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == slow_cut(rows, 100)


def test_a_crowded_minimum_is_not_one_group():
    import pyarrow as pa

    rng = random.Random(12)
    noise = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage = noise(160)
    texts = [noise(80) + passage + noise(80) for _ in range(500)]
    names = ["id", "u1", "u2", "text"]
    units = pa.RecordBatch.from_arrays([pa.array(range(500), pa.int64())] * 3 + [pa.array(texts)], names)
    seen = pa.Table.from_batches(list(suffixes._minima(iter([units]), 100)))
    wanted = [sorted(set(seen["minimum"].filter(pa.compute.equal(seen["u1"], i)).to_pylist())) for i in range(500)]
    runs = {}
    for m, n in zip(seen["minimum"].to_pylist(), seen["runs"].to_pylist(), strict=True):
        runs[m] = runs.get(m, 0) + n
    many = {m for m, n in runs.items() if n > 100}
    assert many
    lists = [pa.array(x, pa.list_(pa.int64())) for x in (wanted, [[m for m in w if m in many] for w in wanted])]
    rows = pa.RecordBatch.from_arrays([*units.columns, *lists], [*names, "minima", "crowded"])
    out = pa.Table.from_batches(list(suffixes._contexts(iter([rows]), 100)))
    have = out.filter(pa.compute.equal(out["later"], 0))["minimum"].to_pylist()
    assert have and max(have.count(m) for m in set(have)) <= 100


def test_licenses_are_found_however_wrapped(spark):
    import textwrap

    before, behind = ("plain words " + "of a longer paragraph " * 30, "more words " * 60)
    docs, want = [], {}
    for width in (30, 35, 40, 45, 50, 55, 60, 70, 80):
        for name, text in licenses.TEMPLATES:
            lines = [x for part in (before, text, behind) for x in textwrap.wrap(part, width, break_long_words=False, break_on_hyphens=False)]
            want[len(docs)] = [name]
            docs.append((len(docs), "\n".join("# " + x for x in lines)))
    found = {i: [] for i in want}
    for r in licenses.scan_licenses(spark.createDataFrame(docs, "doc_id long, text string")).collect():
        found[r.doc_id].append(r.license)
    assert found == want


def test_every_template_that_shortens_enough_is_tried():
    matcher = licenses.Matcher(licenses.TEMPLATES)
    block = [w for _, words in matcher.templates for w in words]
    assert {i for _, i in matcher.ranked(block)} >= {i for i, (_, words) in enumerate(matcher.templates) if len(words) > 30}
    assert len(matcher.ranked(block)) > 6


def test_batches_of_words_are_merged_as_one_by_one():
    rng = random.Random(6)
    parts = ["th", "er", "é", "ñ", "x", "q", "1", "!", "tion", "a", "b", "中"]
    words = list({"".join(rng.choice(parts) for _ in range(rng.randrange(1, 30))) for _ in range(2000)}) + ["x" * 500, "ab" * 300]
    one, many = Merger(word_bpe()), BatchMerger(word_bpe())
    wanted = [one(w) for w in words]
    assert many.all(words) == wanted and [many.one(w.encode()) for w in words] == wanted
    look_up = bpe.Transducer(bpe.compile_words((w.encode(), x) for w, x in zip(words[::2], wanted[::2], strict=True)))
    assert look_up.all(words) == [look_up(w.encode()) for w in words]
    assert bpe.Transducer(bpe.compile_words([])).all(["a", ""]) == [None, None]


def test_runs_of_a_batch_are_those_of_each_text():
    texts = [None, "", " a B\tb ", "<|endoftext|> A b", "x\x1cY\x0bz\r\n", "É Ä \x85"]
    ends, places, runs = runs_in(pa.array(["cut off", *texts], pa.string()).slice(1))
    found = [[runs[p] for p in places[a:b] if runs[p]] for a, b in zip(ends[:-1], ends[1:], strict=True)]
    assert found == [runs_of(t.encode() if t else t) for t in texts]


def test_tokens_do_not_depend_on_what_is_encoded_together(spark, odd, documents, monkeypatch):
    frame = spark.createDataFrame(list(documents.items())[:60], "doc_id long, text string").unionByName(odd.select("doc_id", "text"))
    found = []
    for size in (100, bpe.PIECE):
        monkeypatch.setattr(bpe, "PIECE", size)
        found.append(sorted(map(tuple, bpe.encode_decode(frame, word_bpe(), full=False).collect()), key=str))
    assert found[0] == found[1]


def test_encoding_holds_little_beside_its_text(spark, monkeypatch):
    """what Python and Arrow hold for a piece of ever new words, in multiples of its text."""
    rng = random.Random(4)
    texts = [" ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(600)) for _ in range(200)]
    steps = []
    monkeypatch.setattr(bpe, "map_arrow", lambda docs, step, schema: steps.append(step) or docs)
    monkeypatch.setattr(bpe, "lexicon", lambda *_: bpe.compile_words([]))
    monkeypatch.setattr(bpe, "RUNS", 5_000)
    bpe.encode_decode(spark.createDataFrame([], "doc_id long, text string"), word_bpe(), full=False)
    batch = pa.RecordBatch.from_pydict({"id": list(range(len(texts))), "text": texts})
    monkeypatch.setattr(bpe, "BatchMerger", lambda path, made=BatchMerger(word_bpe()): made)
    size = sum(map(len, texts))
    found = []
    tracemalloc.start()
    for out in steps[0](iter([batch])):
        found.append(out.num_rows)
        most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(found) == len(texts) and most < 30 * size


def test_small_batches_are_gathered_and_large_ones_cut():
    sizes = [3, 50, 1, 1, 120, 7, 0, 40, 40, 40]
    batches = [pa.RecordBatch.from_pydict({"x": ["a" * n], "i": [i]}) for i, n in enumerate(sizes)]
    batches.append(pa.RecordBatch.from_pydict({"x": ["b" * 60] * 4, "i": [10, 11, 12, 13]}))
    found = list(gathered(iter(batches), 0, 100))
    assert [i for b in found for i in b.column(1).to_pylist()] == list(range(14)) and 4 <= len(found) < 10
    assert all(b.column(0).nbytes <= 130 for b in found)


def test_a_name_or_version_decides(spark):
    lgpl = dict(licenses.TEMPLATES[::-1])  # the first of each name
    agpl = next(t for n, t in licenses.TEMPLATES if n == "AGPL-3.0" and len(t) > 100)
    cases = [
        ("GNU General Public License, version 2.", set()),
        ("This work is licensed under the GNU General Public License, version 2.", {"GPL-2.0"}),
        ("This work is licensed under the GNU General Public License, version 4.", set()),
        ("This work is licensed under the GNU Affero General Public License, version 3.", {"AGPL-3.0"}),
        (agpl, {"AGPL-3.0"}),
        (next(t for n, t in licenses.TEMPLATES if n == "LGPL-2.1" and len(t) > 100), {"LGPL-2.1"}),
        ("Licensed under the Apache License, Version 1.1.", {"Apache-1.1"}),
        ("Licensed under the Apache License, Version 3.0.", set()),
        ("To the extent possible under law, the author has waived all copy rights and related rights to this work.", {"CC0-1.0"}),
        ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", {"CC-BY-SA-4.0"}),
        ("Licensed under CC BY-NC-SA 4.0.", set()),
        (lgpl["MIT"].replace("MIT", "ISC"), set()),
    ]
    docs = spark.createDataFrame([(i, f"some words before\n{t}\nand behind") for i, (t, _) in enumerate(cases)], "doc_id long, text string")
    found = {i: set() for i in range(len(cases))}
    for r in licenses.scan_licenses(docs).collect():
        found[r.doc_id].add(r.license)
    assert found == {i: names for i, (_, names) in enumerate(cases)}


def test_no_altered_notice_is_lost_to_the_search_for_candidates(spark):
    """Every template with each of its words altered, against the wording of all templates on the whole text."""
    matcher, rng = licenses.Matcher(licenses.TEMPLATES), random.Random(4)
    docs = []
    for _, words in matcher.templates:
        docs += [words[:i] + ["altered"] + words[i + 1 :] for i in range(len(words))]
        for _ in range(10):
            # Spread out changes, some beyond the bound.
            words_now = list(words)
            for _ in range(rng.randrange(1, 2 + len(words) // 5)):
                at = rng.randrange(len(words_now))
                words_now[at : at + 1] = rng.choice([[], ["altered"], [words_now[at], "added"]])
                words_now = words_now or ["none"]
            docs.append(words_now)
    frame = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(docs)], "doc_id long, text string").repartition(8)
    found = {}
    for r in licenses.scan_licenses(frame).collect():
        found.setdefault(r.doc_id, set()).add(r.license)
    n_found = 0
    for i, words in enumerate(docs):
        near = {}
        for t, (name, template) in enumerate(matcher.templates):
            share, _, _, missing, added = matcher.wording(template, words)
            if share >= licenses.MIN_WORDING and matcher.is_named(t, missing, added):
                near[name] = max(share, near.get(name, 0))
        assert found.get(i, set()) <= set(near) and bool(found.get(i)) == bool(near), (words, found.get(i), near)
        n_found += bool(near)
    assert len(docs) / 2 < n_found < len(docs)
