import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from thermopolis.llm import simhash
from thermopolis.llm.common import components
from thermopolis.llm.queries import QUERIES


def slow_print(text, n=3):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(ids, prints):
    label = list(ids)
    while True:
        new = [min(label[j] for j in range(len(ids)) if (prints[i] ^ prints[j]).bit_count() <= 3) for i in range(len(ids))]
        if new == label:
            return label
        label = new


def test_query_is_brute_force(spark, sf_dir, documents):
    rows = QUERIES["op1_simhash"](spark, sf_dir).collect()
    ids = sorted(documents)
    prints = [slow_print(documents[i]) for i in ids]
    want = {i: (f"{p:016x}", c) for i, p, c in zip(ids, prints, slow_components(ids, prints), strict=True)}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == want and len(rows) == len(ids)


def test_edges(odd, empty):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert {by_id[i].fingerprint for i in (0, 1, 2)} == {"0" * 16}
    assert {by_id[i].component_id for i in (0, 1, 2)} == {0}
    assert sorted(r.component_id for r in rows if r.doc_id is None) == [0, 3]
    assert by_id[4].component_id == 3
    assert simhash.near_duplicates(empty).collect() == []


@settings(max_examples=30, deadline=None)
@given(st.lists(st.lists(st.integers(0, 63), max_size=5), min_size=2, max_size=150), st.integers(0, 4))
def test_bit_slices_are_exact(flips, distance):
    values = sorted({sum(1 << b for b in set(f)) for f in flips})
    a, b = simhash.forest(np.zeros(len(values), int), np.array(values, np.uint64), distance, step=40)
    root = {x: x for x in values} | dict(zip(a.tolist(), b.tolist(), strict=True))
    label = {v: v for v in values}
    while True:
        new = {v: min(label[w] for w in values if (v ^ w).bit_count() <= distance) for v in values}
        if new == label:
            break
        label = new
    assert root == label


def test_a_crowded_bucket_in_tiles_is_one_component(spark):
    base = 0x0123456789ABCDEF
    values = [base ^ (1 << i) ^ (1 << j) for i in range(12) for j in range(i)] + [base ^ (1 << 63)]
    frame = spark.createDataFrame([(simhash.signed(v),) for v in values], "print long")
    for tile in (4096, 7):
        rows = components(simhash.links(frame, 3, tile)).collect()
        assert len({r.node for r in rows}) == len(values) and len({r.component for r in rows}) == 1


def test_components_of_a_long_chain_and_a_hub(spark):
    chain = [(i, i + 1) for i in range(60)]
    hub = [(1000, 1000 + i) for i in range(1, 300)]
    rows = components(spark.createDataFrame(chain + hub + hub, "a long, b long")).collect()
    assert {r.node: r.component for r in rows} == {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(300)}
    assert len(rows) == 361
