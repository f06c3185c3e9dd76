"""N-gram Jaccard join against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from catalogflow.llm import jaccard_join

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text: str | None) -> frozenset:
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    return frozenset([tuple(words)] if 0 < len(words) < 3 else [tuple(words[i:i + 3]) for i in range(len(words) - 2)])


def linked(a: frozenset, b: frozenset, percent: int = 90) -> bool:
    return bool(a) and 100 * len(a & b) >= percent * len(a | b)


def classes(rows: list[tuple]) -> list[tuple]:
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if linked(sets[i], sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            r = find(i) if sets[i] else -i - 1
            least[r] = min(least.get(r, key), key)
    return sorted(((key, len(sets[i]), least.get(find(i) if sets[i] else -i - 1)) for i, (key, _) in enumerate(rows)), key=str)


def varied(rng: random.Random) -> list[tuple]:
    """Chains of edited copies of every length, a passage that strangers share, short texts, copies, nulls."""
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 4)))
    texts = []
    for size in (1, 2, 3, 5, 9, 10, 11, 12, 20, 21, 22, 40, 100, 400):
        words = [word() for _ in range(size)]
        for _ in range(7):
            texts.append(" ".join(words))
            words = list(words)
            for _ in range(max(1, size // 80)):
                at = rng.randrange(len(words))
                words[at:at + rng.choice((0, 1, 1))] = [word()] * rng.choice((0, 1, 1, 2))
            words = words or ["x"]
    passage = [word() for _ in range(60)]
    texts += [" ".join([*[word() for _ in range(rng.randrange(1, 40))], *passage, *[word() for _ in range(rng.randrange(1, 40))]]) for _ in range(40)]
    texts += [" ".join([*passage, word(), *passage[:k]]) for k in range(0, 40, 2)]
    texts += [texts[10].upper(), texts[10], "  \t ", "", None, "é É", "é é", "a b c d e", "a\x0bb c d e", " ".join(["r"] * 500), " ".join(["r"] * 400)]
    rows = [(3 * k, t) for k, t in enumerate(texts)]
    return [*rows, rows[4], rows[4], (None, texts[20]), (None, "alone without a name"), (7, None), (0, "another text under the same id")]


@pytest.mark.parametrize("block", [2, 1024])
def test_classes_against_brute_force(spark, block):
    rows = varied(random.Random(5))
    frame = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, node string")
    got = jaccard_join.jaccard_components(frame, block=block).collect()
    assert sorted((tuple(r) for r in got), key=str) == classes(rows)


def test_every_link(spark):
    rows = varied(random.Random(6))
    links, documents = jaccard_join.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string"), block=3)
    assert documents.filter("node IS NULL").count() == sum(not shingles(t) for _, t in rows)
    kinds = list({shingles(t) for _, t in rows if shingles(t)})
    want = sum(linked(a, b) for i, a in enumerate(kinds) for b in kinds[:i])
    found = links.collect()
    assert len({tuple(sorted((bytes(r.a), bytes(r.b)))) for r in found}) == len(found) == want > 40


def test_empty_table(spark):
    assert jaccard_join.jaccard_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_similar_sets_share_a_signature():
    """The guarantee itself, for random pairs just inside the limit, of all sizes."""
    rng = np.random.default_rng(2)
    for size in [*range(1, 60), 97, 250, 999, 3000]:
        for _ in range(12):
            a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
            gone, new = (int(x) for x in rng.integers(0, len(a) // 8 + 2, 2))
            b = np.unique(np.concatenate([rng.permutation(a)[min(gone, len(a) - 1):], rng.integers(0, 1 << 63, new, dtype=np.uint64)]))
            joint = len(np.intersect1d(a, b))
            if 100 * joint < 90 * (len(a) + len(b) - joint) or joint == len(a) == len(b):
                continue
            keys, number = jaccard_join.signatures(np.concatenate([a, b]), np.array([len(a), len(b)]))
            assert set(keys[:number[0]].tolist()) & set(keys[number[0]:].tolist())


@pytest.mark.parametrize("percent", [50, 80, 90, 95])
def test_rules_keep_the_pigeonhole(percent):
    low, high = jaccard_join.bands(percent, 5000)
    assert low[0] == 1 and (low[1:] == high[:-1] + 1).all()
    for a, b in zip(low.tolist(), high.tolist()):
        assert 100 * a < percent * (b + 1)
        first, second, spare = jaccard_join.band_rule(percent, a, b)
        k = 2 * b * (100 - percent) // (100 + percent)
        assert (first == 0) == (k == 0)
        if first:
            assert first * (spare + 1) > k and second > spare
