import functools
import hashlib
import itertools
import random
import re
import zlib

import pytest

from corpuscope.llm import repair

from . import cases

WHITE = " \t\n\x0b\x0c\r"


def spoilt(rows):
    """Rows of each conversation after damage, in order."""
    found = {}
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        turns = found.setdefault(conv, [])
        if kind == 0:
            continue
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        turns += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    order = lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode())
    return {c: sorted(t, key=order) for c, t in found.items()}


def faults(turns):
    out, seen = [], set()
    for _, role, text in turns:
        last = text.rstrip(WHITE)[-1:]
        out.append("blank" if not last else "duplicate" if (role, text) in seen else "" if last in ".!?" else "truncated")
        seen.add((role, text))
    return out


def search(turns, found):
    """(cost, audit, lines) by trying every edit at every place."""

    @functools.cache
    def rest(k, state):
        """Least (cost, audit, lines) of the edits from turn k on, given the last initial."""
        options = []
        follow = {"": "u", "s": "u", "u": "a", "a": "u"}[state]
        role = {"u": "user", "a": "assistant"}[follow]
        if k == len(turns):
            if state in ("", "a"):
                options.append((0, "", ()))
        else:
            _, own, text = turns[k]
            cost, audit, lines = rest(k + 1, state)
            options.append((cost + 2, "D" + audit, lines))
            if found[k] not in ("blank", "duplicate"):
                extra = 5 * (found[k] == "truncated")
                cost, audit, lines = rest(k + 1, follow)
                options.append((cost + 1 + extra, "R" + audit, (f"{role}:{text}", *lines)))
                if own[:1] == follow or (own[:1] == "s" and not state):
                    cost, audit, lines = rest(k + 1, own[:1])
                    options.append((cost + extra, "K" + audit, (f"{own}:{text}", *lines)))
        # A third insert in a row leads back to a state that was free.
        for n in (1, 2):
            new, after = [], state
            for _ in range(n):
                after = {"": "u", "s": "u", "u": "a", "a": "u"}[after]
                new.append({"u": "user:", "a": "assistant:"}[after])
            if k == len(turns):
                if after == "a":
                    options.append((5 * n, "I" * n, tuple(new)))
                continue
            _, own, text = turns[k]
            cost, audit, lines = rest(k + 1, after)
            options.append((cost + 2 + 5 * n, "I" * n + "D" + audit, (*new, *lines)))
            if found[k] not in ("blank", "duplicate"):
                extra = 5 * (found[k] == "truncated")
                follow = {"u": "a", "a": "u"}[after]
                role = {"u": "user", "a": "assistant"}[follow]
                cost, audit, lines = rest(k + 1, follow)
                options.append((cost + 1 + extra + 5 * n, "I" * n + "R" + audit, (*new, f"{role}:{text}", *lines)))
                if own[:1] == follow:
                    options.append((cost + extra + 5 * n, "I" * n + "K" + audit, (*new, f"{own}:{text}", *lines)))
        return min(options, default=(10**9, "", ()))

    return rest(0, "")


def brute(rows):
    out = {}
    for conv, turns in spoilt(rows).items():
        found = faults(turns)
        numbers = [t for t, _, _ in turns if t is not None]
        initials = [r[:1] for _, r, _ in turns]
        cost, audit, lines = search(turns, found)
        out[conv] = (
            max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
            *(found.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)),
            cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


@pytest.mark.parametrize("clashing", [False, True])
def test_equals_brute_force(spark, clashing):
    rows = cases.dialogues(most=12)
    long = [(901, t, "user", "Go on.") for t in range(120)]
    rows = [r for r in rows if r[0] != 900 or r[1] < 150] + long
    want = brute(rows)
    got = repair.report(cases.turn_frame(spark, rows, clashing).repartition(3)).collect()
    assert len(got) == len(want)
    assert {r.conv_id: tuple(r)[1:] for r in got} == want


def everything(codes):
    """(cost, audit) by writing out all strings of edits and testing the grammar."""
    best = None
    for gaps in itertools.product(range(3), repeat=len(codes) + 1):
        if sum(gaps) > 4:
            continue
        for letters in itertools.product("DKR", repeat=len(codes)):
            for new in itertools.product("ua", repeat=sum(gaps) + letters.count("R")):
                given, initials, audit, cost = iter(new), "", "", 0
                for k, gap in enumerate(gaps):
                    initials += "".join(next(given) for _ in range(gap))
                    audit, cost = audit + "I" * gap, cost + 5 * gap
                    if k < len(codes):
                        audit += letters[k]
                        cost += {"D": 2, "K": 0, "R": 1}[letters[k]]
                        if letters[k] != "D":
                            initials += codes[k][0] if letters[k] == "K" else next(given)
                            cost += {"+": 0, "~": 5, "-": 10**6}[codes[k][1]]
                if re.fullmatch("(s?(ua)+)?", initials) and (best is None or (cost, audit) < best):
                    best = (cost, audit)
    return best


def data(codes):
    return bytes(repair.Codes.KNOWN.index(c) for c in codes)


def test_all_short_conversations():
    for n in range(3):
        for codes in itertools.product(repair.Codes.KNOWN, repeat=n):
            assert repair.cheapest(data(codes)) == everything(codes), codes


def test_inserts_when_deleting_breaks_more(monkeypatch):
    """With dear deletions and new roles, inserts and their order against ties come into play."""
    monkeypatch.setattr(repair, "INSERT", 1)
    repair.steps.cache_clear()
    monkeypatch.setattr(repair, "DELETE", 2)
    rng = random.Random(8)
    for _ in range(300):
        codes = [rng.choice(repair.Codes.KNOWN) for _ in range(rng.randrange(40))]
        at = {0: (0, "")}
        for code in codes:
            after = {}
            for state, (cost, audit) in at.items():
                for q, price, edits in repair.steps(code)[state]:
                    found = (cost + price, audit + edits)
                    after[q] = min(after.get(q, found), found)
            at = after
        want = min((c + len(repair.ENDS[s]), a + repair.ENDS[s]) for s, (c, a) in at.items())
        assert repair.cheapest(data(codes)) == want
    repair.steps.cache_clear()


def test_linear_space_on_a_long_conversation():
    import tracemalloc

    rng = random.Random(2)
    codes = bytes(rng.randrange(12) for _ in range(20000))
    tracemalloc.start()
    cost, audit = repair.cheapest(codes)
    assert tracemalloc.get_traced_memory()[1] < 4 << 20
    tracemalloc.stop()
    at = {0: 0}
    for code in repair.Codes(codes):
        after = {}
        for state, c in at.items():
            for q, price, _ in repair.steps(code)[state]:
                after[q] = min(after.get(q, c + price), c + price)
        at = after
    assert cost == min(c + 5 * len(repair.ENDS[s]) for s, c in at.items())
    assert len(audit.replace("I", "")) == 20000


def test_repaired_turns_and_empty_table(spark):
    rows = [(3, 1, "user", "Hi."), (3, 2, "user", "More."), (3, 3, "tool", "Yes!"), (3, 4, "assistant", "   ")]
    frame = cases.turn_frame(spark, rows)
    from pyspark.sql import functions as F

    whole = frame.select(F.col("conv_id").alias("conv"), "turn", "role", "text", F.lit(False).alias("gone"))
    found = repair.audits(whole)
    assert tuple(found.first())[1:] == (0, 1, 0, 0, 3, 5, "DKRD")
    got = [tuple(r)[1:] for r in repair.apply(whole, found).collect()]
    assert got == [(0, "K", "user", "More."), (1, "R", "assistant", "Yes!")]
    assert repair.report(cases.turn_frame(spark, [])).collect() == []


def test_conversations_across_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        rows = cases.dialogues(seed=9, n=20)
        rows = [r for r in rows if r[0] != 900]
        got = repair.report(cases.turn_frame(spark, rows)).collect()
        assert {r.conv_id: tuple(r)[1:] for r in got} == brute(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
