import re
from collections import Counter

import numpy as np
from llm.texts import awkward, frame, prose, words
from txrisk.llm import quality

LABELS = "doc_id bigint, quality int"


def counts(text):
    text = text or ""
    w = words(text, lower=False)
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    again = {g for g, n in Counter(grams).items() if n > 1}
    covered = {i + j for i, g in enumerate(grams) if g in again for j in range(5)}
    lines, seen, dup = [x for x in text.split("\n") if words(x)], set(), 0
    for line in lines:
        dup += line in seen
        seen.add(line)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered))


def rows():
    line = prose(70, 12)
    return awkward() + [
        (100, f"{line}\n{line}\n{line} \n\n\n{line.upper()}\n{line}"), (101, "a b c d e " * 9 + prose(71, 20)),
        (102, "\n\n \n"), (103, "#*$%&|<> " * 5 + "é# \U0001f642 x"), (104, "w " * 9), (105, prose(72, 10)),
        (106, line + "\n"), (107, "a b c d e f a b c d e g h i j k l m n o p q r s t u v w"),
    ]


def test_counts_and_base_rules_equal_brute_force(spark):
    found = quality.quality(frame(spark, rows()), frame(spark, [], LABELS)).collect()
    assert len(found) == len(rows())
    texts = dict(rows())
    for r in found:
        if r.doc_id is None:
            continue
        want = counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        # without labels the forest rejects nothing
        assert r.kept != r.base_failed


def test_chunks_of_many_texts_count_like_single_ones(spark):
    import pyarrow as pa
    from txrisk.llm.words import text_chunks

    texts = [t for _, t in rows()]
    for limit in (1, 100, 10**7):
        found = np.concatenate([quality.text_counts(c) for c in text_chunks(pa.array(texts), limit)])
        assert [tuple(x[:5]) for x in found.tolist()] == [counts(t) for t in texts]


def test_labelled_junk_is_found_and_good_text_kept(spark):
    docs = [(i, prose(i, 40 + i % 50)) for i in range(400)]
    docs += [(i, " ".join(w + "#$%&"[j % 4] * 3 for j, w in enumerate(prose(i, 60).split()))) for i in range(400, 440)]
    labels = [(i, int(i < 400)) for i in range(440)] + [(None, 0), (1, None), (2, 5)]
    found = {r.doc_id: r for r in quality.quality(frame(spark, docs), frame(spark, labels, LABELS)).collect()}
    assert sum(found[i].kept for i in range(400)) >= 396
    assert sum(found[i].kept for i in range(400, 440)) <= 10


def test_outliers_have_short_paths():
    x = np.random.default_rng(0).normal(size=(2000, 4))
    x[0] = 30
    scores = quality.grow(x).scores(x)
    assert scores.argmax() == 0 and scores[0] > 0.65 and np.median(scores) < 0.5
    same = quality.grow(np.zeros((10, 4)))
    assert len(set(same.scores(np.zeros((5, 4))))) == 1


def test_empty_table(spark):
    assert quality.quality(frame(spark, []), frame(spark, [], LABELS)).collect() == []


def test_documents_with_one_fault_are_not_hidden_by_good_ones(spark):
    """Equal short lines between different ones, and capitals: neither reaches the base rules."""

    def lined(seed, n):
        w = prose(seed, n).split()
        return "\n".join(" ".join(w[i : i + 12]) for i in range(0, n, 12))

    docs = [(i, lined(i, 40 + i % 200)) for i in range(600)]
    for i in range(600, 660):
        between = [prose(10_000 + 20 * i + j, 4 + j % 5) for j in range(12)]
        docs.append((i, "\n".join(line for other in between for line in (prose(5_000 + i, 4), other))))
    docs += [(i, prose(i, 60 + i % 40).upper()) for i in range(660, 720)]
    labels = [(i, int(i < 600)) for i in range(720)]
    found = {r.doc_id: r for r in quality.quality(frame(spark, docs), frame(spark, labels, LABELS)).collect()}
    assert not any(r.base_failed for r in found.values())
    assert sum(found[i].kept for i in range(600)) >= 597
    assert sum(found[i].kept for i in range(600, 660)) <= 3
    assert sum(found[i].kept for i in range(660, 720)) <= 3
    assert {found[i].rejected_by for i in range(600, 660)} - {None} <= {"shape", *quality.STATISTICS}


def test_a_repeated_id_calibrates_without_leaving_spark(spark):
    docs = [(1, prose(i, 50)) for i in range(3000)] + [(2, "#$%& " * 40 + prose(i, 12)) for i in range(20)]
    labels = [(1, 1), (2, 0), (2, 1)]
    found = quality.quality(frame(spark, docs), frame(spark, labels, LABELS)).collect()
    assert sum(r.kept for r in found if r.doc_id == 1) >= 2990
    assert len(found) == 3020


def test_limits_stay_within_the_loss_and_need_evidence():
    good, bad = np.zeros((2, 10), int), np.zeros((2, 10), int)
    good[:, 2] = 997
    good[0, 5], good[0, 8] = 2, 1
    good[1, 3] = 3
    bad[0, 6], bad[1, 2] = 50, 50
    # one good row may go: that is what 50 bad ones cost, and the second forest finds none
    assert quality.limits(good, bad, 0.001).tolist() == [6, 10]
    assert quality.limits(good, bad, 0.0).tolist() == [10, 10]
    bad[0, 9] = 2
    assert quality.limits(good, bad, 0.0).tolist() == [10, 10]
    bad[0, 9] = 3
    assert quality.limits(good, bad, 0.0).tolist() == [9, 10]
    assert quality.limits(good, bad * 0).tolist() == [10, 10]
