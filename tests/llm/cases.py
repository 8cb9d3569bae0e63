"""Small documents with the awkward cases every operator has to take."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, key string, th string, "
          "spans string, n_words string, kept string, pieces string, score string, class_id string")


def words(rnd, n, vocabulary=400):
    return " ".join(f"w{rnd.randrange(vocabulary)}" for _ in range(n))


def texts(seed=1):
    rnd = random.Random(seed)
    base = words(rnd, 120)
    edited = base.split()
    edited[60] = "changed"
    passage = words(rnd, 70)
    out = [base, base, " ".join(edited), words(rnd, 30) + " " + passage + " " + words(rnd, 20),
           passage + "\n" + words(rnd, 40), words(rnd, 25) + "\n" + passage, None, "", "   \n\t ", "one", "a b c",
           "x " * 300, "ab ab ab " * 50, "é😀\u2581 ñandú\u00a0中文 " * 30, "q" * 3000, passage]
    out += [words(rnd, rnd.randrange(5, 150)) for _ in range(14)]
    out.append(words(rnd, 4000, 100_000) + " " + passage)
    return out


def frame(spark, rows=None, start=0):
    """Documents (with columns whose names the operators use themselves), one
    of them without an id, one repeated as a whole."""
    rows = texts() if rows is None else rows
    made = [(start + i, t, None if i % 7 == 3 else "en", None if i % 5 == 2 else "s", len(t or ""),
             "k", "t", "s", "n", "kept", "p", "0", "c") for i, t in enumerate(rows)]
    if start == 0 and len(made) > 5:
        made.append((None, made[4][1], *made[4][2:]))
        made.append(made[3])
    return spark.createDataFrame(made, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
