"""Small documents tables for the corpus operators, and plain-Python versions of their rules."""

import hashlib
import random
import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
BLANK = re.compile(r"[\x20\x09-\x0D]+")


def frame(spark, rows):
    """documents from (doc_id, text, source)."""
    return spark.createDataFrame(
        [(d, t, "xx", s, None if t is None else len(t)) for d, t, s in rows], DOCS)


def words(text):
    return [w for w in BLANK.split(text or "") if w]


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def prose(seed, n, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def corpus(seed=3, docs=60):
    """Prose with shared passages and lines, copies, near copies, nulls, blanks and a long text."""
    rng = random.Random(seed)
    passage, line = prose("p", 70), "  All Rights RESERVED. "
    rows = []
    for d in range(docs):
        text = prose(d, rng.randrange(3, 160))
        kind = d % 10
        if kind == 1:
            text = f"{text}\n{passage}\n{prose(d + 1000, 20)}"
        elif kind == 2:
            text = f"{text}\n{line}\n\n{line.lower()}"
        elif kind == 3:
            text = rows[-3][1]
        elif kind == 4:
            text = " ".join(w if i != 5 else "edited" for i, w in enumerate(words(prose(4, 120)))) if d > 10 else prose(4, 120)
        elif kind == 5:
            text = prose(d, 4) + " Ünïcode 你好 \U0001f600 " + prose(4, 60)
        rows.append((d * 3, text, f"s{d % 4}" if d % 7 else None))
    rows += [(1000, None, "s1"), (1001, "", "s1"), (1002, " \t\n\x0b", None), (1003, prose("long", 20_000), "s2"),
             (1004, "a a a a a a a a " * 30, "s2"), (1005, "few words", "s3"), (1006, "few words", "s3")]
    return rows


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}
