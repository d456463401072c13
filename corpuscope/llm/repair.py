"""Conversation structure repaired by the cheapest edits, found by divide and conquer.

A conversation is in order if its roles' initials read ``(s?(ua)+)?``. Reading them, one is in
one of four states: nothing yet, after ``s``, after ``u``, after ``a``. An edit is a step
between states at a cost, so the cheapest edits are a shortest path through the turns, four
states wide. Of equally cheap ones that with the least string of initials (the
audit) counts.

Only two vectors of four costs are held: one goes forward from the start to the middle of
the conversation, one backward from its end; where their sum is least, the path crosses. Both
halves are then solved alike. The forward vector also carries the order of the four
states by their least audits so far: inserts belong to the turn after them, so of two audits
of the same turns none begins with the other, and the order of states decides which of the
cheapest crossings has the least audit, without comparing audits.

Turns stream through a task in order. For its conversation a task holds 17 bytes per turn (a
code and a digest) while it looks for the edits, and then the audit while it applies them;
texts are never held, so a conversation may have any length.

Cases: null role and text are one space; the order is turn (nulls first), role, text; equal
rows are duplicates; a role that begins with none of s, u, a (also an empty one) is never
kept as it is; rows without a conversation id are one conversation; a conversation without
rows has an empty audit; an empty table gives no rows; columns besides conv_id, turn, role
and text are not looked at.
"""

from __future__ import annotations

import functools
import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuscope.llm.common import id_back, id_key, stored

# What edits cost, and the steps between the states start, s, u, a (0 to 3).
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ENDS = {0: "", 3: "", 2: "I", 1: "II"}
LEGAL = {"su", "ua", "au"}
WHITE = " \t\n\x0b\x0c\r"
#: Results of conversations up to this many turns are remembered, so many of them.
SHORT, REMEMBERED = 24, 50_000
#: Characters of results sent on at once.
BATCH = 4 << 20


def needed(state: int) -> str:
    """Role of a turn that is inserted or given a new role in a state."""
    return "assistant" if state == 2 else "user"


@functools.cache
def steps(code: str) -> tuple:
    """Per state before a turn: tuples (state after it, cost, edits); one per state after.

    ``code`` is the initial of the role (``x`` for others) and how the turn is: ``+`` good,
    ``~`` truncated, ``-`` to be deleted.
    """
    initial, how = code
    extra = TRUNCATED if how == "~" else 0
    table = []
    for start in range(4):
        best: dict[int, tuple[int, str]] = {}
        state, cost, edits = start, 0, ""
        for _ in range(3):
            options = [(state, DELETE, "D")]
            if how != "-":
                options.append((STEP[state, needed(state)[0]], REROLE + extra, "R"))
                if (state, initial) in STEP:
                    options.append((STEP[state, initial], extra, "K"))
            for after, price, letter in options:
                found = (cost + price, edits + letter)
                best[after] = min(best.get(after, found), found)
            state, cost, edits = STEP[state, needed(state)[0]], cost + INSERT, edits + "I"
        table.append(tuple((after, c, e) for after, (c, e) in sorted(best.items())))
    return tuple(table)


def forward(turns, start: int) -> dict[int, tuple[int, int]]:
    """State: (least cost from ``start``, place of its least audit among the states)."""
    at = {start: (0, 0)}
    for code in turns:
        table, found = steps(code), {}
        for state, (cost, place) in at.items():
            for after, price, edits in table[state]:
                option = (cost + price, place, edits)
                if after not in found or option < found[after]:
                    found[after] = option
        order = sorted(found, key=lambda s: found[s][1:])
        at = {s: (found[s][0], k) for k, s in enumerate(order)}
    return at


def backward(turns, end: int) -> dict[int, int]:
    """State: least cost from it to ``end``."""
    at = {end: 0}
    for code in reversed(turns):
        found: dict[int, int] = {}
        for state, options in enumerate(steps(code)):
            costs = [price + at[after] for after, price, _ in options if after in at]
            if costs:
                found[state] = min(costs)
        at = found
    return at


def crossing(turns, middle: int, start: int, end: int) -> int:
    """State at ``middle`` of the cheapest path with the least audit."""
    left, right = forward(turns[:middle], start), backward(turns[middle:], end)
    return min(
        (s for s in left if s in right), key=lambda s: (left[s][0] + right[s], left[s][1])
    )


def between(turns, start: int, end: int) -> str:
    """Audit of the cheapest path from one state to another."""
    audit, todo = [], [(turns, start, end)]
    while todo:
        part, first, last = todo.pop()
        if len(part) == 1:
            audit.append(next(e for after, _, e in steps(part[0])[first] if after == last))
        elif part:
            middle = len(part) // 2
            state = crossing(part, middle, first, last)
            todo.append((part[middle:], state, last))
            todo.append((part[:middle], first, state))
    return "".join(audit)


class Codes:
    """Turns as one byte each, read as codes; slices are views."""

    KNOWN = [i + h for i in "suax" for h in "+~-"]

    def __init__(self, data):
        self.data = memoryview(data)

    def __len__(self):
        return len(self.data)

    def __getitem__(self, at):
        return Codes(self.data[at]) if isinstance(at, slice) else self.KNOWN[self.data[at]]

    def __iter__(self):
        return map(self.KNOWN.__getitem__, self.data)

    def __reversed__(self):
        return map(self.KNOWN.__getitem__, reversed(self.data))


def cheapest(data: bytes) -> tuple[int, str]:
    """Cost and audit of a whole conversation."""
    turns = Codes(data)
    ends = {
        s: (cost + INSERT * len(ENDS[s]), place) for s, (cost, place) in forward(turns, 0).items()
    }
    end = min(ends, key=ends.get)
    return ends[end][0], between(turns, 0, end) + ENDS[end]


@functools.lru_cache(REMEMBERED)
def remembered(data: bytes) -> tuple[int, str]:
    return cheapest(data)


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv, turn, role, text, gone): rows spoilt by a rule on their key.

    Of twenty remainders of a checksum one drops the row, one empties its text, one takes its
    sentence ends away, one repeats it and one makes it a user's. Dropped rows stay, marked
    as gone, so that their conversations do.
    """
    space = F.lit(" ")
    key = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), space),
        F.lit(":"),
        F.coalesce(F.col("turn").cast("string"), space),
    )
    kind = F.crc32(key.cast("binary")) % 20
    text = F.coalesce(F.col("text").cast("string"), space)
    rows = conversations.select(
        id_key("conv_id").alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, "user")
        .otherwise(F.coalesce(F.col("role").cast("string"), space))
        .alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
        .alias("text"),
        (kind == 0).alias("gone"),
        F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))).alias("copies"),
    )
    return rows.withColumn("copy", F.explode("copies")).drop("copy", "copies")


def _how(text: Column) -> Column:
    """Fault of a text on its own: ``-`` blank, ``~`` truncated, ``+`` none."""
    last = F.right(F.rtrim(text, F.lit(WHITE)), F.lit(1))
    return F.when(last == "", "-").when(last.isin(".", "!", "?"), "+").otherwise("~")


def _in_order(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows of a conversation in one partition, sorted; the sort may spill."""
    order = ("conv", *keys, "turn", "role", "text")
    return rows.repartition("conv").sortWithinPartitions(*order)


def _batches(rows, schema: pa.Schema, size):
    """Record batches of tuples, cut by the sum of ``size(row)``."""
    held, total = [], 0
    for row in rows:
        held.append(row)
        total += size(row)
        if total >= BATCH:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in held], schema)
            held, total = [], 0
    if held:
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in held], schema)


def _rows(batches):
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


class Faults:
    """What is seen of one conversation while its turns pass."""

    def __init__(self):
        self.codes, self.seen = bytearray(), set()
        self.low = self.high = None
        self.turns = self.illegal = 0
        self.found = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.initial = None

    def add(self, turn, initial: str, how: str, digest: bytes) -> None:
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high = turn
            self.turns += 1
        if self.initial is not None and self.initial + initial not in LEGAL:
            self.illegal += 1
        self.initial = initial
        if how == "-":
            self.found["blank"] += 1
        elif digest in self.seen:
            self.found["duplicate"] += 1
            how = "-"
        elif how == "~":
            self.found["truncated"] += 1
        self.seen.add(digest)
        kind = "sua".find(initial) if initial else -1
        self.codes.append(3 * (kind if kind >= 0 else 3) + "+~-".index(how))

    def result(self) -> tuple:
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        codes = bytes(self.codes)
        cost, audit = (remembered if len(codes) <= SHORT else cheapest)(codes)
        return (gaps, *self.found.values(), self.illegal, cost, audit)


AUDIT = pa.schema(
    [(n, pa.int64()) for n in ("conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    + [("audit", pa.string())]
)
AUDIT_SQL = (
    "conv long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long,"
    " audit string"
)


def audits(rows: DataFrame) -> DataFrame:
    """Per conversation the counts of its faults, and cost and audit of its repair.

    ``rows`` has conv, turn, role, text, none null but turn, and gone.
    """
    told = F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")
    ordered = _in_order(rows).select(
        "conv",
        "turn",
        F.substring("role", 1, 1).alias("initial"),
        _how(F.col("text")).alias("how"),
        F.unhex(F.substring(F.sha2(told, 256), 1, 32)).alias("digest"),
        "gone",
    )

    def found(batches):
        conv = faults = None
        for key, turn, initial, how, digest, gone in _rows(batches):
            if key != conv:
                if faults:
                    yield (conv, *faults.result())
                conv, faults = key, Faults()
            if not gone:
                faults.add(turn, initial, how, digest)
        if faults:
            yield (conv, *faults.result())

    def run(batches):
        return _batches(found(batches), AUDIT, lambda r: 100 + len(r[-1]))

    return ordered.mapInArrow(run, AUDIT_SQL)


TURN = pa.schema(
    [("conv", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]
)


def apply(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv, place, edit, role, text): the repaired turns, in order in their partition."""
    first = audits.select(
        "conv",
        F.lit(0).alias("kind"),
        F.lit(None).cast("long").alias("turn"),
        F.lit("").alias("role"),
        F.col("audit").alias("text"),
    )
    turns = rows.where("not gone").select("conv", F.lit(1).alias("kind"), "turn", "role", "text")

    def edited(batches):
        conv = state = place = at = 0
        audit = ""

        def inserts():
            nonlocal state, place, at
            while audit[at : at + 1] == "I":
                role = needed(state)
                yield (conv, place, "I", role, "")
                state, place, at = STEP[state, role[0]], place + 1, at + 1

        for key, kind, role, text in _rows(batches):
            if kind == 0:
                yield from inserts()
                conv, state, place, at, audit = key, 0, 0, 0, text
                continue
            yield from inserts()
            edit = audit[at]
            at += 1
            if edit != "D":
                role = needed(state) if edit == "R" else role
                yield (conv, place, edit, role, text)
                state, place = STEP[state, role[0]], place + 1
        yield from inserts()

    def run(batches):
        return _batches(edited(batches), TURN, lambda r: 100 + len(r[-1]))

    both = _in_order(first.unionByName(turns), "kind").select("conv", "kind", "role", "text")
    return both.mapInArrow(run, "conv long, place long, edit string, role string, text string")


def digests(turns: DataFrame) -> DataFrame:
    """(conv, sha256) of ``role:text`` lines, from turns that lie in order."""

    def summed(batches):
        conv = digest = None
        for key, role, text in _rows(batches):
            if digest is None or key != conv:
                if digest:
                    yield (conv, digest.hexdigest())
                conv, digest = key, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode())
        if digest:
            yield (conv, digest.hexdigest())

    schema = pa.schema([("conv", pa.int64()), ("sha256", pa.string())])

    def run(batches):
        return _batches(summed(batches), schema, lambda r: 100)

    return turns.select("conv", "role", "text").mapInArrow(run, "conv long, sha256 string")


def report(conversations: DataFrame) -> DataFrame:
    rows = damaged(conversations)
    found = stored(audits(rows), "repair-audits")
    sums = digests(apply(rows, found))
    return found.join(sums, "conv", "left").select(
        id_back("conv", "conv_id"),
        *AUDIT.names[1:],
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def _sql() -> str:
    """The same rows in SQL: cost and audit of each state as one string that sorts like them."""

    def add(value: str, cost, letter: str) -> str:
        return (
            f"lpad((({value})[1:8]::INT + {cost})::VARCHAR, 8, '0') || ({value})[9:] || '{letter}'"
        )

    def keep(value: str, initial: str) -> str:
        return f"CASE WHEN t.initial = '{initial}' AND NOT gone THEN {add(value, 'extra', 'K')} END"

    def rerole(value: str) -> str:
        return f"CASE WHEN NOT gone THEN {add(value, f'{REROLE} + extra', 'R')} END"

    def delete(value: str) -> str:
        return add(value, DELETE, "D")

    def insert(value: str) -> str:
        return add(value, INSERT, "I")

    to_user = [f(v) for v in ("w.z", "w.s", "w.a1") for f in (lambda v: keep(v, "u"), rerole)]
    return rf"""
    WITH RECURSIVE byte AS (
        SELECT list(list_reduce([k, 0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[],
            lambda c, z: xor(c >> 1, 3988292384 * (c & 1))) ORDER BY k) AS crc
        FROM range(256) AS r(k)),
    keyed AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
            list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':'
                || coalesce(turn::VARCHAR, ' '), ''), lambda x: ascii(x)::UBIGINT) AS chars
        FROM conversations),
    summed AS (
        SELECT * EXCLUDE (chars, crc), xor(list_reduce(list_prepend(4294967295::UBIGINT, chars),
            lambda c, x: xor(c >> 8, crc[((xor(c, x) & 255) + 1)::BIGINT])), 4294967295) % 20
            AS kind
        FROM keyed, byte),
    spoilt AS (
        SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
            CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g')
                ELSE text END AS text,
            unnest(CASE kind WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
        FROM summed WHERE kind <> 0),
    lined AS (
        SELECT *, role[1] AS initial, row_number()
            OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place
        FROM spoilt),
    told AS (
        SELECT *, coalesce(lag(initial) OVER (PARTITION BY conv_id ORDER BY place) || initial, 'su')
                AS pair,
            CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
                WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1
                THEN 'duplicate'
                WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated'
                ELSE '' END AS fault
        FROM lined),
    t AS (
        SELECT conv_id, place, initial, fault IN ('blank', 'duplicate') AS gone,
            CASE fault WHEN 'truncated' THEN {TRUNCATED} ELSE 0 END AS extra
        FROM told),
    walk AS (
        SELECT DISTINCT conv_id, 0::BIGINT AS place, '00000000' AS z, NULL::VARCHAR AS s,
            NULL::VARCHAR AS u, NULL::VARCHAR AS a
        FROM conversations
        UNION ALL
        SELECT w.conv_id, t.place, {delete("w.z")},
            least({delete("w.s")}, {keep("w.z", "s")}),
            least({delete("w.u1")}, {", ".join(to_user)}),
            least({delete("w.a1")}, {keep("w.u1", "a")}, {rerole("w.u1")})
        FROM (SELECT *, least(a, {insert("u1")}) AS a1 FROM (
                SELECT *, least(u, {insert("z")}, {insert("s")}, {insert("a")}) AS u1
                FROM walk)) w
            JOIN t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.place = w.place + 1),
    best AS (
        SELECT conv_id, arg_max(least(z, a, {insert("u")}, {insert(insert("s"))}), place) AS best
        FROM walk GROUP BY conv_id),
    letters AS (
        SELECT conv_id, unnest(string_split(best[9:], '')) AS letter,
            generate_subscripts(string_split(best[9:], ''), 1) AS k
        FROM best WHERE best[9:] <> ''),
    placed AS (
        SELECT *, count(*) FILTER (letter <> 'I') OVER (PARTITION BY conv_id ORDER BY k) AS place
        FROM letters),
    kept AS (
        SELECT p.conv_id, k, letter, CASE letter WHEN 'I' THEN '' ELSE text END AS text, role,
            row_number() OVER c AS j,
            first_value(letter = 'K' AND told.initial = 's') OVER c AS system
        FROM placed p LEFT JOIN told
            ON told.conv_id IS NOT DISTINCT FROM p.conv_id AND told.place = p.place
        WHERE letter <> 'D' WINDOW c AS (PARTITION BY p.conv_id ORDER BY k)),
    lines AS (
        SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role
            WHEN (j - system::INT) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text,
            chr(10) ORDER BY k) AS lines
        FROM kept GROUP BY conv_id),
    counted AS (
        SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
            count_if(fault = 'blank') AS blank, count_if(fault = 'duplicate') AS duplicate,
            count_if(fault = 'truncated') AS truncated,
            count_if(pair NOT IN ('su', 'ua', 'au')) AS illegal
        FROM told GROUP BY conv_id)
    SELECT b.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
        coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
        coalesce(illegal, 0)::BIGINT AS illegal, best[1:8]::BIGINT AS cost, best[9:] AS audit,
        sha256(coalesce(lines, '')) AS repaired_sha256
    FROM best b LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM b.conv_id
        LEFT JOIN lines l ON l.conv_id IS NOT DISTINCT FROM b.conv_id"""


SQL = _sql()
