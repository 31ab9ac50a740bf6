import hashlib
import random
import zlib
from collections import defaultdict
from functools import lru_cache

from txrisk.llm import alignment, conversations

SCHEMA = "conv_id bigint, turn bigint, role string, text string, kind int, place int, copies string, audit string"


def best_repair(codes):
    """Cost and edits by a search over every edit of every turn; two insertions in a row at most."""

    @lru_cache(None)
    def search(i, state, inserted):
        found = []
        following = "a" if state == "u" else "u"
        if i == len(codes) and state in "0a":
            found.append((0, ""))

        def add(cost, edit, rest):
            if rest:
                found.append((cost + rest[0], edit + rest[1]))

        if inserted < 2:
            add(2, "I", search(i, following, inserted + 1))
        if i < len(codes):
            code = codes[i]
            add(3, "D", search(i + 1, state, 0))
            if code != "d":
                extra, role = int(code.isupper()), code.lower()
                same = role == following
                add(extra + (0 if same else 2), "K" if same else "R", search(i + 1, following, 0))
                if role == "s" and state == "0":
                    add(extra, "K", search(i + 1, "s", 0))
        return min(found, default=None)

    return search(0, "0", 0)


def test_alignments_equal_a_full_search():
    rng = random.Random(1)
    for _ in range(700):
        codes = "".join(rng.choice("suauauaxSUAXdd") for _ in range(rng.randint(0, 26)))
        chain = alignment.Chain()
        chain.ends = alignment.follow(chain.ends, codes)
        assert chain.best() == best_repair(codes)
        # the same in runs of any length
        parts, at = alignment.Chain(), 0
        while at < len(codes):
            step = rng.randint(1, 12)
            parts.add(alignment.run_table(codes[at : at + step]))
            at += step
        assert parts.best() == chain.best()


def brute(rows, damaged=True):
    """conv_id -> the report, and the repaired turns, conversation by conversation in memory."""
    turns = defaultdict(list)
    for conv_id, turn, role, text in rows:
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20 if damaged else 9
        role, text = " " if role is None else role, " " if text is None else text
        turns[conv_id]
        if kind == 0:
            continue
        text = {1: "", 2: "".join(c for c in text if c not in ".!?")}.get(kind, text)
        role = "user" if kind == 4 else role
        turns[conv_id] += [(turn, role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv_id, own in turns.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        seen, codes, counts = set(), "", dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, role, text in own:
            said = text.strip(" \t\n\x0b\x0c\r")
            fault = (
                "blank" if not said else "duplicate" if (role, text) in seen
                else "truncated" if said[-1] not in ".!?" else ""
            )
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            code = role[:1] if role[:1] in ("s", "u", "a") else "x"
            codes += "d" if fault in ("blank", "duplicate") else code.upper() if fault else code
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(own, own[1:])]
        numbers = {t for t, _, _ in own if t is not None}
        chain = alignment.Chain()
        chain.ends = alignment.follow(chain.ends, codes)
        cost, audit = best_repair(codes) if len(codes) < 200 else chain.best()
        left, state, at = [], "0", 0
        for edit in audit:
            if edit in "IR":
                state = "a" if state == "u" else "u"
                role = {"u": "user", "a": "assistant"}[state]
                left.append((role, "" if edit == "I" else own[at][2]))
            elif edit == "K":
                state = own[at][1][:1]
                left.append(own[at][1:])
            at += edit != "I"
        text = "\n".join(f"{r}:{t}" for r, t in left)
        out[conv_id] = (
            max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0,
            *counts.values(),
            sum(p not in ("su", "ua", "au") for p in pairs),
            cost,
            audit,
            hashlib.sha256(text.encode()).hexdigest(),
        ), left
    return out


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "x", None) for r in rows], SCHEMA).repartition(3)


def random_rows(seed, conversations_, longest):
    rng = random.Random(seed)
    rows = []
    for c in range(conversations_):
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool"])
            rows.append((c, turn * rng.choice([1, 1, 2]), role, rng.choice(["Yes.", "No", "Why? ", f"Turn {turn}!", " "])))
    return rows


AWKWARD = [
    (None, 1, "user", "Hi."),
    (None, None, None, None),
    (900, None, "user", "a"),
    (900, None, "user", "b."),
    (900, 3, "", ""),
    (901, None, None, None),
    (902, -5, "assistant", "x" * 300_000 + "."),
    (902, 5, "user", " " * 200_000 + "?" + " " * 200_000),
    *[(903, 2, "user", "Same.")] * 700,
    (904, 1, "usual", "é\U0001f642."),
]


def check(spark, rows, damaged=True):
    turns = table(spark, rows)
    prepared = conversations.damage(turns) if damaged else conversations.as_turns(turns)
    want = brute(rows, damaged)
    found = conversations.repair(prepared).collect()
    assert {r.conv_id: tuple(r)[1:] for r in found} == {c: report for c, (report, _) in want.items()}
    assert len(found) == len(want)
    left = defaultdict(list)
    for r in sorted(conversations.repaired_turns(prepared).collect(), key=lambda r: r.place):
        if r.role is not None:
            left[r.conv_id].append((r.role, r.text))
    assert dict(left) == {c: turns for c, (_, turns) in want.items() if turns}


def test_reports_equal_brute_force(spark):
    check(spark, random_rows(1, 120, 14) + AWKWARD)
    check(spark, random_rows(2, 40, 10) + AWKWARD, damaged=False)


def test_one_long_conversation_spans_slices(spark):
    rng = random.Random(5)
    roles = ["user", "assistant"] * 700
    rows = [(7, i, rng.choice([r, r, r, "user", "system"]), f"{i}{rng.choice('.!?x')}") for i, r in enumerate(roles)]
    check(spark, rows + [(6, 1, "user", "Q?"), (6, 2, "assistant", "A."), (8, 1, "user", "Q?")])


def test_dropped_conversations_and_empty_tables(spark):
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    found = conversations.repair(conversations.damage(table(spark, [(dropped, 1, "user", "Hi.")]))).collect()
    assert [tuple(r) for r in found] == [(dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert conversations.repair(conversations.damage(table(spark, []))).collect() == []
