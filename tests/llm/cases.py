"""Small tables with the awkward rows that every operator has to take."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = (
    "the of and river stone light paper winter green market number seven window silver garden "
    "letter corner bridge summer yellow orange quiet morning engine table forest harbour signal "
    "copper velvet Ünder größe niño"
).split()


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) for _ in range(n))


def rows(texts, first: int = 0):
    return [
        (first + i, t, "en", f"src{i % 3}", None if t is None else len(t))
        for i, t in enumerate(texts)
    ]


def awkward():
    """Null, empty, blank, very long, repeated, with null ids, sources and languages."""
    rng = random.Random(5)
    long = "\n".join(sentence(rng, 12) for _ in range(4000))
    return [
        (1, None, None, None, None),
        (2, "", "en", "src0", 0),
        (3, " \t\n\r\x0b\x0c ", "en", "src0", 7),
        (4, "one two three", "en", "src1", 13),
        (4, "one two three", "en", "src1", 13),
        (5, "ONE two THREE", "en", "src1", 13),
        (None, "no id here at all", "en", None, 17),
        (None, None, "en", "src2", None),
        (6, long, "en", "src2", len(long)),
        (7, long, "en", None, len(long)),
        (8, "\U0001f600 Ünïcode   text here ſ K", "de", "src0", 24),
        (9, sentence(rng, 90), "en", "src0", 0),
    ]
