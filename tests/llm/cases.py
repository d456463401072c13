"""Rows that every operator has to survive."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that clash with names the operators use inside.
CLASHING = SCHEMA + ", doc string, row string, key string, count string, part string, fp string"


def words(rng, n, vocabulary=4000):
    return " ".join("w%d" % rng.randrange(vocabulary) for _ in range(n))


def corpus(seed=5, n=60):
    """Nulls, empty and long texts, ties, repeated rows, exact and near copies."""
    rng = random.Random(seed)
    base = [words(rng, rng.randrange(1, 300)) for _ in range(n)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(1000 + i, base[3]) for i in range(25)]
    rows += [(1100 + i, base[4].replace(" ", "  \n", 1 + i)) for i in range(5)]
    for i in range(30):
        near = base[7].split() or ["x"]
        near[rng.randrange(len(near))] = "edit%d" % i
        rows.append((1200 + i, " ".join(near)))
    rows += [(2000, None), (2001, ""), (2002, "   \n"), (None, "alone here"), (None, base[3]),
             (2003, None), (5, base[5]), (5, "other text of the same id"), (2004, words(rng, 60000)),
             (2005, "Ä ö ß € 😀 ñandú"), (2006, "a" * 5000), (-7, base[9])]
    rng.shuffle(rows)
    return rows


def frame(spark, rows, clashing=False):
    if clashing:
        return spark.createDataFrame(
            [(d, t, "en", "src0", len(t or "")) + ("z",) * 6 for d, t in rows], CLASHING
        )
    return spark.createDataFrame([(d, t, "en", "src0", len(t or "")) for d, t in rows], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


TURNS = "conv_id long, turn long, role string, text string"
TURNS_CLASHING = TURNS + ", conv string, parts string, piece string, count string, loss string"


def dialogues(seed=3, n=60, most=9):
    """Conversations with nulls, ties, repeated rows, odd roles, markers and long texts."""
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "so", "", "  \t", None, "</turn>", "<\\turn><says><", "a <next> b",
             "<\\\\next>\\", "<turn", "turn>", "ñ😀 <", ">", "x" * 5000, "Yes.", "End.\n"]
    roles = ["user", "assistant"] * 6 + ["system", "tool", None, "<turn>", "", "a\nb"]
    rows = []
    for conv in [*range(n), None]:
        for turn in range(rng.randrange(1, most)):
            role = rng.choice(["user", "assistant"]) if rng.random() < 0.7 else rng.choice(roles)
            rows.append((conv, rng.choice([turn] * 8 + [None, 2]), role, rng.choice(texts)))
            if rng.random() < 0.1:
                rows.append(rows[-1])
    for turn in range(400):
        rows.append((900, turn, rng.choice(roles), rng.choice(texts) or "?"))
    rng.shuffle(rows)
    return rows


def turn_frame(spark, rows, clashing=False):
    if clashing:
        return spark.createDataFrame([(*r, *("z",) * 5) for r in rows], TURNS_CLASHING)
    return spark.createDataFrame(rows, TURNS)
