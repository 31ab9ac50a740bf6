import numpy as np
import pytest
from llm.texts import awkward, frame, prose, words
from txrisk.llm import near_dup
from txrisk.llm.components import components


def brute(rows, k, percent=80):
    sets, ids = {}, sorted({i for i, _ in rows if i is not None})
    for i, text in rows:
        w = words(text)
        grams = [tuple(w[j : j + k]) for j in range(len(w) - k + 1)] or ([tuple(w)] if w else [])
        sets[i] = set(grams)
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x in ids:
        for y in ids:
            both = len(sets[x] & sets[y])
            if x < y and both and 100 * both >= percent * len(sets[x] | sets[y]):
                a, b = sorted((root(x), root(y)))
                parent[b] = a
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


def near_copies(n):
    """A group of near copies that straddles the similarity: words changed at random places."""
    import random

    rng, base = random.Random(4), prose(9, 120).split()
    out = []
    for i in range(n):
        copy = list(base)
        for j in rng.sample(range(len(copy)), rng.randint(0, 16)):
            copy[j] = f"w{rng.randint(0, 10**6)}"
        out.append((100 + i, " ".join(copy)))
    return out


@pytest.mark.parametrize("k", [2, 5])
def test_groups_equal_brute_force(spark, k):
    rows = awkward() + near_copies(60)
    found = near_dup.near_duplicates(frame(spark, rows), k=k).collect()
    assert len(found) == len(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found if r.doc_id is not None}
    assert got == brute(rows, k)
    assert all(r.kept and r.component_id is None for r in found if r.doc_id is None)


def test_empty_table(spark):
    assert near_dup.near_duplicates(frame(spark, [])).collect() == []


def test_every_bin_is_filled_and_bins_estimate_similarity():
    rng = np.random.default_rng(0)
    values = rng.integers(0, 2**63, 1200, dtype=np.uint64)
    sketches = near_dup.sketch_sets([values[:1000], values[200:], values[:1], values[:3]])
    assert (sketches != np.iinfo(np.uint64).max).all()
    # 800 of 1200 in common
    assert abs((sketches[0] == sketches[1]).mean() - 2 / 3) < 0.15


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    found = components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    assert {r.node: r.component for r in found} == {
        **{i: 1 for i in range(1, 41)},
        **{100 + i: 100 for i in range(30)},
    }


def test_one_row_of_each_group_stays_whatever_its_id(spark):
    text, other = prose(3, 60), prose(4, 60)
    rows = [(1, text), (1, text), (2, text), (None, text), (None, text + " more"), (1, other), (7, other)]
    rows += [(None, prose(5, 40)), (3, ""), (3, None), (None, " ")]
    docs = frame(spark, rows, partitions=3)
    left = near_dup.without_copies(docs)
    assert left.columns == docs.columns
    found = [(r.doc_id, r.text) for r in left.collect()]
    assert [x for x in found if x[1] and x[1].startswith(text)] == [(1, text)]
    assert len([x for x in found if x[1] == other]) == 1 and (7, other) in found
    assert (None, prose(5, 40)) in found
    assert sorted(found, key=str)[-3:] and len(found) == 6
    assert near_dup.without_copies(frame(spark, [])).collect() == []
