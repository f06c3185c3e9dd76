"""Rows and helpers shared by the tests of the corpus operators."""

from __future__ import annotations

import random

DOC = "doc_id long, text string, lang string, source string, n_chars long, _row string, score double, kept boolean, node string"
SF_DIR = "/root/testdata/sf0.01"


def prose(rng: random.Random, words: int) -> str:
    return " ".join("".join(rng.choice(["ka", "lo", "mi", "ter", "un", "sé", "dra"]) for _ in range(rng.randrange(1, 5))) for _ in range(words))


def documents() -> list[tuple]:
    """Copies, near copies, shared passages, nulls, ties, repeated rows, one very long text; three columns with names operators use."""
    rng = random.Random(4)
    base = [prose(rng, rng.randrange(30, 160)) for _ in range(40)]
    near = []
    for text in base[:12]:
        words = text.split(" ")
        words[len(words) // 2] = "changed"
        near.append(" ".join(words))
    passage = prose(rng, 60)
    shared = [prose(rng, 80) + "\n" + passage + "  " + prose(rng, 70) for _ in range(6)]
    texts = [*base, *near, *shared, base[3].upper(), base[3], "", None, "é", "!!! ***", "one two", "a" * 700, "ab " * 400, prose(rng, 40_000)]
    rng.shuffle(texts)
    rows = [(10 * i + 7, t) for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], (None, base[0]), (None, None), (rows[8][0], "another text under the same id"), (3, None)]
    langs = ["en", None, "de"]
    return [(i, t, langs[k % 3], "src0" if k % 3 == 0 else None, None, "x", 0.5, False, None) for k, (i, t) in enumerate(rows)]


def source_of(frame) -> str:
    """The folder of a frame read from Parquet."""
    return frame.inputFiles()[0].rpartition("/")[0]
