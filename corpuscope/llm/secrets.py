"""Secrets in texts, found by one automaton for all rules.

All rules are compiled into one transition array (``automaton.py``) that reads each byte
once. Only where it reports a rule, transition arrays give the spans: one that reads backward
tells where matches begin, and one of the rule alone how far they reach, leftmost first and
without overlap. A lane ends behind a byte no rule can pass, so no match, wanted or not, crosses
its border; a text without such bytes is cut into parts that are read side by side.

Cases: null text is empty and has no spans; repeated rows are reported each; texts are scanned
whole, however long; spans of several kinds at one place are in the order of the rules; an empty
table gives no rows; columns besides id and text are not looked at. Places are counted in
code points, ends exclusive.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuscope.llm.automaton import Spans, compiled, scan
from corpuscope.llm.common import id_back, slices, texts

BYTES = 1 << 20


def either(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


@dataclass(frozen=True)
class Rule:
    kind: str
    #: What the automaton looks for: a string that every span of the rule has. Counting far is
    #: left to ``spans`` where the counts of several rules would multiply the states.
    pattern: str
    #: Gives the spans; behind ``lead`` they have at least ``least`` bytes.
    spans: str
    least: int = 0
    lead: str = ""


KEYS = "|".join([*map(either, ("password", "passwd", "secret", "token")), "[Aa][Pp][Ii]_?[Kk][Ee][Yy]"])
LEAD = f"({KEYS})" + r"""["']?\x20*[:=]\x20*["']?"""

BASE = (
    Rule("assign", f"{LEAD}[A-Za-z0-9+/_.=-]{{6,}}", f"{LEAD}[A-Za-z0-9+/_.=-]+", 6, LEAD),
    Rule("access", "AKIA[A-Z0-9]", "AKIA[A-Z0-9]+", 20),
    Rule("hex", "[0-9a-f]{24,}", "[0-9a-f]+", 24),
)
MORE = (
    Rule("github", "gh[pousr]_[A-Za-z0-9]", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE + MORE


def find(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc, spans): per row, array of (kind, start, end) by start, then order of rules."""
    machine = compiled([r.pattern for r in rules])
    exact = Spans([r.spans for r in rules])
    leads = [Spans([r.lead]).ahead[0] if r.lead else None for r in rules]

    def spans_in(data: bytes, begin: int, end: int, bits: int):
        for s, k, e in exact(data, begin, end, bits):
            own = leads[k].longest(data, s, e) if leads[k] else s
            if e - own >= rules[k].least:
                yield s, k, e

    def run(batches):
        for batch in batches:
            data = batch.column(1).cast(pa.binary()).to_pylist()
            for a, b in slices([len(d) for d in data], BYTES):
                # A line end passes no rule, so lanes end with their texts.
                buffer = b"\n".join(data[a:b]) + b"\n"
                ends = np.cumsum([len(d) + 1 for d in data[a:b]])
                per_doc = [[] for _ in range(b - a)]
                for begin, end, bits in zip(*scan(machine, np.frombuffer(buffer, np.uint8))):
                    for s, k, e in spans_in(buffer, int(begin), int(end), int(bits)):
                        doc = int(np.searchsorted(ends, s, side="right"))
                        base = int(ends[doc - 1]) if doc else 0
                        per_doc[doc].append((s - base, k, e - base))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array(
                            [placed(d, s) for d, s in zip(data[a:b], per_doc)],
                            pa.list_(pa.struct({"kind": pa.string(), "start": pa.int64(), "end": pa.int64()})),
                        ),
                    ],
                    names=["doc", "spans"],
                )

    def placed(data: bytes, spans):
        """Bytes to code points."""
        out, at, count = [], 0, 0
        for s, k, e in sorted(spans):
            count += len(data[at:s].decode())
            at = s
            out.append({"kind": rules[k].kind, "start": count, "end": count + len(data[s:e].decode())})
        return out

    return texts(docs).mapInArrow(
        run, "doc long, spans array<struct<kind: string, start: long, end: long>>"
    )


def report(docs: DataFrame) -> DataFrame:
    rows = find(docs)
    written = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
    of = lambda kind: F.filter("spans", lambda s: s["kind"] == kind)
    base = F.filter("spans", lambda s: s["kind"].isin([r.kind for r in BASE]))
    return rows.select(
        id_back(),
        *(F.size(of(r.kind)).cast("long").alias(f"n_{r.kind}") for r in BASE),
        F.sha2(written(base), 256).alias("base_sha256"),
        written("spans").alias("spans"),
    )
