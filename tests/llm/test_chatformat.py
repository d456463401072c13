import hashlib
import itertools
import re

import pytest
from pyspark.sql import functions as F

from corpuscope.llm import chatformat

from . import cases


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def ordered(rows):
    """Turns of each conversation: by number, nulls first, then role and text."""
    found = {}
    for conv, turn, role, text in rows:
        found.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    key = lambda t: (t[0], t[1], t[2].encode(), t[3].encode())
    return {c: [(r, x) for _, _, r, x in sorted(t, key=key)] for c, t in found.items()}


def stuffed(text):
    return re.sub(r"<(\\*(?:turn|says|next|/turn)>)", r"<\\\1", text)


def brute(rows):
    out = {}
    for conv, turns in ordered(rows).items():
        text = ""
        for role, run in itertools.groupby(turns, key=lambda t: t[0]):
            text += f"<turn>{stuffed(role)}<says>" + "<next>".join(stuffed(x) for _, x in run) + "</turn>\n"
        learnt = "".join(x for r, x in turns if r == "assistant")
        out[conv] = (
            len(turns), sha("".join(f"{r}\n{x}\n" for r, x in turns)), len(learnt), sha(learnt), len(text),
        )
    return out


@pytest.mark.parametrize("clashing,many", [(False, 4096), (True, 50), (False, 1)])
def test_equals_brute_force(spark, clashing, many):
    rows = cases.dialogues()
    got = chatformat.report(cases.turn_frame(spark, rows, clashing).repartition(3), many).collect()
    assert {r.conv_id: tuple(r)[1:] for r in got} == brute(rows)
    assert len(got) == len(brute(rows))


def test_texts_and_loss_ranges(spark):
    rows = [(1, 0, "user", "a</turn>"), (1, 1, "assistant", "é<\\turn>"), (1, 2, "assistant", ""),
            (1, 3, "assistant", "z"), (2, None, None, None)]
    got = {r.conv: r for r in chatformat.formatted(cases.turn_frame(spark, rows)).collect()}
    assert got[1].text == (
        "<turn>user<says>a<\\/turn></turn>\n<turn>assistant<says>é<\\\\turn><next><next>z</turn>\n"
    )
    data = got[1].text.encode()
    assert [data[s.start : s.start + s.bytes].decode() for s in got[1].loss] == ["é<\\\\turn>", "", "z"]
    assert got[2].text == "<turn><says></turn>\n" and got[2].loss == []


def test_prefix_sums_over_chunks(spark):
    n = 3 * chatformat.CHUNK + 5
    sizes = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda x: x.cast("long")).alias("s"))
    for part in (F.col("s"), F.slice("s", 1, chatformat.CHUNK), F.slice("s", 1, 0)):
        r = sizes.select(part.alias("s"), chatformat.before(part).alias("b")).first()
        assert r.b == [0, *itertools.accumulate(r.s)][:-1] if r.s else r.b == []


def test_empty_table_and_plan(spark, capsys):
    frame = cases.turn_frame(spark, [])
    assert chatformat.report(frame).collect() == []
    chatformat.report(cases.turn_frame(spark, [(1, 1, "user", "x")])).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange hashpartitioning") == 1
