from collections import Counter, defaultdict

import pytest
from llm.texts import frame, prose, words
from txrisk.llm import mixing

COLUMNS = "doc_id bigint, text string, source string"


def corpus():
    rows = [(i, prose(i, 20 + i % 7), "hot") for i in range(300)]
    rows += [(1000 + i, prose(1000 + i, 25), f"s{i % 3}") for i in range(60)]
    rows += [(2000, None, "s0"), (2001, "", None), (2002, "a b", None), (2003, "", "empty")]
    return rows + [(2004, "twice the same", "s1")] * 2


def run(spark, rows, target, block_tokens=500):
    found = mixing.mix(frame(spark, rows, COLUMNS), target, block_tokens)
    return found.select("row.doc_id", "row.text", "source", "tokens", "pass", "block", "before").collect()


def budgets_by_hand(rows, target):
    n = Counter()
    for _, text, source in rows:
        n["null" if source is None else f"={source}"] += len(words(text))
    n = {s: c for s, c in n.items() if c}
    total = sum(n.values())

    def weights(alpha):
        w = {s: (c / total) ** alpha for s, c in n.items()}
        return {s: x / sum(w.values()) for s, x in w.items()}

    def passes(alpha):
        w = weights(alpha)
        budget = target.budget or max(n[s] / w[s] for s in n)
        return max(w[s] * budget / n[s] for s in n)

    low, high = 0.0, 1.0
    for _ in range(mixing.HALVINGS):
        mid = (low + high) / 2
        low, high = (low, mid) if passes(mid) <= target.max_passes else (mid, high)
    w = weights(high)
    budget = target.budget or max(n[s] / w[s] for s in n)
    return n, {s: w[s] * budget for s in n}


@pytest.mark.parametrize("target", [mixing.Target(2.0, budget=9000), mixing.Target(1.5)])
def test_budgets_are_met_by_whole_documents(spark, target):
    rows = corpus()
    found = run(spark, rows, target)
    n, budget = budgets_by_hand(rows, target)
    used, passes = Counter(), defaultdict(Counter)
    for r in found:
        used[r.source] += r.tokens
        passes[r.source][r.doc_id] += 1
    longest = 40
    for source, wanted in budget.items():
        assert wanted - longest <= used[source] <= wanted + 1
        assert max(passes[source].values()) <= 2 * -(-wanted // n[source])  # a row twice in the table
    if target.budget is None:
        assert {r.doc_id for r in found} == {i for i, _, _ in rows}


def test_passes_are_permutations_and_columns_stay(spark):
    rows = corpus()
    found = run(spark, rows, mixing.Target(2.0, budget=9000))
    texts = {i: t for i, t, _ in rows}
    assert all(r.text == texts[r.doc_id] for r in found)
    first = [r for r in found if r.source == "=s2" and r["pass"] == 0]
    assert Counter(r.doc_id for r in first) == Counter(i for i, _, s in rows if s == "s2")
    orders = {
        p: sorted({(r.before, r.block) for r in found if r.source == "=hot" and r["pass"] == p})
        for p in {r["pass"] for r in found if r.source == "=hot"}
    }
    assert all([b for _, b in o] == list(range(len(o))) for o in orders.values())
    # documents without words are used once
    assert sum(r.doc_id == 2003 for r in found) == 1


def test_entropy_target(spark):
    docs = frame(spark, corpus(), COLUMNS)
    sources = mixing.with_tokens(docs).groupBy("key").sum("tokens").toDF("key", "tokens")
    import math

    def entropy(alpha):
        n = [r.tokens for r in sources.collect() if r.tokens]
        w = [(c / sum(n)) ** alpha for c in n]
        return -sum(x / sum(w) * math.log(x / sum(w)) for x in w)

    alpha = mixing.exponent(sources.where("tokens > 0"), mixing.Target(entropy=1.0))
    assert 0 < alpha < 1 and entropy(alpha) >= 1.0 - 1e-9 and entropy(alpha + 1e-6) < 1.0


def test_empty_table(spark):
    assert run(spark, [], mixing.Target(1.5)) == []
