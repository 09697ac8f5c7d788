"""Small documents with every awkward case, shared by the operators' tests."""

from __future__ import annotations

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "name string, h long, block int, key string, node long, label int, score double, digest string, size int")
EXTRA = ("n", 1, 2, "k", 3, 4, 0.5, "d", 6)


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    syllables = ["an", "the", "or", "tion", "er", "ha", "ing", "re", "st", "ou"]
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(n))


def rows() -> list[tuple]:
    base = prose(1, 120)
    words = base.split()
    near = " ".join(["altered", *words[1:]])
    texts = [
        (1, base, "en", "a"), (2, base, "en", "a"), (3, base.upper(), "en", "b"), (4, near, "en", "b"),
        (5, None, "en", "a"), (6, "", None, None), (7, " \n\t ", "fr", "a"),
        (8, prose(8, 3), "en", "b"), (9, prose(9, 40_000), "en", "a"),
        (10, prose(10, 200), "de", "c"), (10, prose(10, 200), "de", "c"),   # a repeated row
        (11, prose(11, 50), "de", "c"), (11, prose(12, 50), "de", "c"),     # one id, two texts
        (None, prose(13, 60), None, "a"), (None, prose(13, 60), None, "a"), (None, prose(14, 60), "en", None),
        (12, "É" + "a" * 5000, "fr", "c"), (13, "é" + "a" * 5000, "fr", "c"),
        (14, "漢字 🙂 \\ ### </turn> x", "en", "a"),
    ]
    return [(i, t, lang, src, None if t is None else len(t), *EXTRA) for i, t, lang, src in texts]


def docs(spark, which=None):
    return spark.createDataFrame(rows() if which is None else which, SCHEMA)


def empty(spark):
    return docs(spark, [])


def lowered(t: str | None) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
