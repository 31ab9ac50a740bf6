from collections import Counter

from llm.texts import awkward, frame, prose, words
from txrisk.llm import decontaminate

ITEMS = [
    (0, prose(50, 30)), (1, prose(51, 45)), (2, "three short words"), (3, None), (4, ""),
    (5, "rose is a rose is a rose is a rose is a rose"), (None, prose(52, 20)), (6, prose(53, 30)),
]


def documents():
    passage = ITEMS[0][1]
    edited = passage.split()
    edited[3] = "changed"
    half = " ".join(passage.split()[:15])
    return awkward() + [
        (100, prose(60, 50) + " " + passage.upper() + " " + prose(61, 50)),
        (101, " ".join(edited)),
        (102, half + " " + prose(62, 40)),
        (103, "we say Three  short\nwords here"),
        (104, ITEMS[5][1] + " is a rose"),
        (105, " ".join([ITEMS[1][1]] * 3)),
        (106, passage + " " + ITEMS[6][1] + " " + ITEMS[7][1]),
        (None, passage),
    ]


def brute(rows, items, least):
    """The best weighted similarity of any window as long as the item."""
    out = {}
    for i, text in rows:
        w = words(text)
        for item, t in items:
            x = words(t)
            if item is None or not x or len(w) < len(x):
                continue
            k = min(5, len(x))
            own = Counter(tuple(x[j : j + k]) for j in range(len(x) - k + 1))
            best = None
            for s in range(len(w) - len(x) + 1):
                v = w[s : s + len(x)]
                grams = Counter(tuple(v[j : j + k]) for j in range(len(v) - k + 1))
                sim = sum((own & grams).values()) / sum((own | grams).values())
                if sim >= least and (best is None or sim > best[0]):
                    best = sim, s
            if best:
                out[i, item] = best
    return out


def test_matches_equal_brute_force(spark):
    rows = documents()
    benchmark = frame(spark, ITEMS, "item_id bigint, text string")
    want = brute(rows, ITEMS, 0.8)
    assert {k[0] for k in want} >= {100, 103, 104, 105, 106, None}
    for item_bytes in (decontaminate.ITEM_BYTES, 300):
        found = decontaminate.benchmark_matches(frame(spark, rows), benchmark, 0.8, item_bytes)
        got = {(r.doc_id, r.item_id): (r.similarity, r.first_word) for r in found.collect()}
        assert got == want


def test_rows_without_a_match_stay_whole(spark):
    rows = documents()
    docs = frame(spark, rows)
    kept = decontaminate.without_matches(docs, frame(spark, ITEMS, "item_id bigint, text string"))
    assert kept.columns == docs.columns
    bad = {k[0] for k in brute(rows, ITEMS, 0.8)} - {None}
    assert {r.doc_id for r in kept.collect()} - {None} == {i for i, _ in rows if i} - bad


def test_documents_shorter_than_the_item_are_one_window(spark):
    item = prose(80, 40)
    cut = lambda text, n: " ".join(text.split()[:n])
    items = [(0, item), (1, prose(81, 9)), (2, "four short words here"), (3, prose(82, 4) + " " + prose(82, 4))]
    rows = [(n, cut(item, n)) for n in range(3, 40)] + [(100 + n, cut(items[1][1], n)) for n in range(1, 9)]
    rows += [(200, "four short words"), (201, "short"), (202, cut(items[3][1], 7)), (203, " ".join(item.split()[2:]))]
    want = {}
    for i, text in rows:
        for n, t in items:
            k = min(5, len(words(t)))
            own, grams = (
                Counter(tuple(w[j : j + k]) for j in range(len(w) - k + 1)) for w in (words(t), words(text))
            )
            sim = sum((own & grams).values()) / sum((own | grams).values())
            if sim >= 0.8:
                want[i, n] = sim, 0, 1
    assert {(39, 0), (203, 0), (108, 1)} <= set(want) and (30, 0) not in want
    benchmark = frame(spark, items, "item_id bigint, text string")
    found = decontaminate.benchmark_matches(frame(spark, rows), benchmark).collect()
    assert {(r[0], r[1]): tuple(r[2:]) for r in found} == want and len(found) == len(want)
    kept = decontaminate.without_matches(frame(spark, rows), benchmark).collect()
    assert {r.doc_id for r in kept} == {i for i, _ in rows} - {i for i, _ in want}


def test_every_text_of_an_item_counts_with_or_without_an_id(spark):
    texts = [prose(90 + i, 25) for i in range(4)]
    items = [(7, texts[0]), (7, texts[1]), (7, texts[1]), (None, texts[2]), (None, texts[3])]
    rows = [(i, prose(95, 5) + " " + t) for i, t in enumerate(texts)] + [(9, prose(99, 40))]
    benchmark = frame(spark, items, "item_id bigint, text string")
    for item_bytes in (decontaminate.ITEM_BYTES, 200):
        found = decontaminate.benchmark_matches(frame(spark, rows), benchmark, 0.8, item_bytes)
        got = [tuple(r) for r in found.select("doc_id", "item_id", "similarity", "first_word").collect()]
        assert sorted(got) == [(0, 7, 1.0, 5), (1, 7, 1.0, 5)]
    assert [r.doc_id for r in decontaminate.without_matches(frame(spark, rows), benchmark).collect()] == [9]


def test_empty_tables(spark):
    none = frame(spark, [], "item_id bigint, text string")
    assert decontaminate.benchmark_matches(frame(spark, documents()), none).collect() == []
    assert decontaminate.benchmark_matches(frame(spark, []), none).collect() == []
    assert decontaminate.without_matches(frame(spark, documents()), none).count() == len(documents())


def test_index_finds_all_within_the_radius():
    import numpy as np

    items = decontaminate.Items([(i, prose(i, 30)) for i in range(40)])
    prints = items.prints[30]
    rng = np.random.default_rng(3)
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, 22, replace=False)) for _ in prints], np.uint64)
    near = set(items.near(prints ^ flips, 30))
    want = {
        (x, items.by_words[30][y])
        for x, p in enumerate((prints ^ flips).tolist())
        for y, q in enumerate(prints.tolist())
        if (p ^ q).bit_count() <= 22
    }
    assert near == want and len(want) >= 40
