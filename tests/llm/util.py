"""Fixtures and brute-force helpers for the text operators."""

import random
import re

SPACES = " \t\n\x0b\x0c\r"
LETTERS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: a table with the columns of documents, and some whose names the operators use inside
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, h long, kid string, n int, score string"


def frame(spark, pairs, parts=3, lang="en"):
    rows = [(i, t, lang, "s", None if t is None else len(t), "r", 1, "k", 2, "x") for i, t in pairs]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def lower(t):
    return (t or "").translate(LETTERS)


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(t))


def prose(seed, n, vocab=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocab)}" for _ in range(n))


#: null, empty, blank, ties and repeated rows, a long text, one line and word many times, non-ASCII letters
HARD = [(1, None), (2, ""), (3, " \t\r "), (4, prose(4, 60)), (4, prose(4, 60)), (5, prose(4, 60)), (None, prose(4, 60)),
        (None, "Solo text"), (6, "a"), (7, prose(7, 12_000)), (8, "Same line\n" * 30), (9, "İstanbul É é x 中文 😀\nSame line"),
        (10, "x" * 9000), (10, "another text of ten"), (11, "\n\n\n")]
