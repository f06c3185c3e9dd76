"""The three kinds of deduplication against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from corpus_rows import DOC, prose, source_of
from pyspark.sql import functions as F

from catalogflow.llm import exact_dedup, induced, near_dedup, suffix_dedup
from catalogflow.llm.components import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def order(i):
    return (i is not None, i or 0)


# --- exact -----------------------------------------------------------------------------------------------------------


def weak(text):
    """A digest with many collisions."""
    return (F.length(text) % 3).cast("string").cast("binary")


def few(text):
    """A digest under which two texts collide."""
    return F.when(text.isin("é", "one two"), F.lit("same").cast("binary")).otherwise(exact_dedup.sha256(text))


@pytest.mark.parametrize("settings", [{}, {"files_per_trigger": 1}, {"digest": weak}, {"digest": few}])
def test_exact_groups(spark, docs, rows, settings):
    found = exact_dedup.exact_duplicates(spark, source_of(docs), docs.schema, **settings).collect()
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[(t or "").translate(LOWER)].append(i)
    expected = Counter()
    for text, ids in groups.items():
        for i in ids:
            expected[(i, max(ids, key=order), len(ids), hashlib.sha256(text.encode()).hexdigest())] += 1
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in found) == expected
    kept = Counter(r["text_sha256"] for r in found if r["kept"])
    assert set(kept.values()) == {1} and len(kept) == len(groups)


def test_exact_dedup_keeps_columns(spark, docs, rows, no_docs):
    kept = exact_dedup.exact_dedup(spark, source_of(docs), docs.schema)
    assert kept.schema == docs.schema
    assert kept.count() == len({(r[1] or "").translate(LOWER) for r in rows})
    assert exact_dedup.exact_dedup(spark, source_of(no_docs), no_docs.schema).count() == 0
    assert exact_dedup.exact_duplicates(spark, source_of(no_docs), no_docs.schema).count() == 0


def test_state_is_on_disk_and_settings_are_put_back(spark, docs):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    groups = exact_dedup.stream_groups(spark, source_of(docs), docs.schema)
    assert groups.count() > 0
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before
    assert "RocksDB" in exact_dedup._STATE["spark.sql.streaming.stateStore.providerClass"]


# --- near ------------------------------------------------------------------------------------------------------------


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_banded_alignment():
    rng = random.Random(2)
    for _ in range(1500):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(14))] for _ in range(2))
        true, x, y = distance(a, b), np.array(a, np.uint32), np.array(b, np.uint32)
        for most in range(8):
            assert near_dedup.edit_within(x, y, most) == (true if true <= most else None)
        if a or b:
            assert near_dedup.similar(x, y, 0.8) == (1 - true / max(len(a), len(b)) >= 0.8 - 1e-12)


def test_rotated_texts_take_the_memory_of_the_band():
    """Words that agree as a bag and not in order pass every bound before the alignment."""
    import time
    import tracemalloc

    rng = np.random.default_rng(4)
    for words in (rng.integers(0, 1 << 32, 20_000, dtype=np.uint32), rng.integers(0, 300, 20_000, dtype=np.uint32)):
        turned = np.concatenate([words[10_000:], words[:10_000]])
        tracemalloc.start()
        start = time.process_time()
        assert not near_dedup.similar(words, turned)
        took, (_, peak) = time.process_time() - start, tracemalloc.get_traced_memory()
        tracemalloc.stop()
        assert peak < 100e6 and took < 10
    near = np.concatenate([words[3000:], words[:3000]])
    assert near_dedup.edit_within(words, near, 6000) is not None and near_dedup.edit_within(words, words[5:], 5) == 5


def test_alignment_through_anchors():
    rng = random.Random(6)
    for _ in range(300):
        a = [rng.randrange(rng.choice([6, 400])) for _ in range(rng.randrange(3, 60))]
        b = list(a)
        for _ in range(rng.randrange(8)):
            k = rng.randrange(len(b))
            b[k:k + rng.randrange(2)] = [rng.randrange(400) for _ in range(rng.randrange(2))]
        if len(b) >= 3:
            x, y = np.array(a, np.uint64), np.array(b, np.uint64)
            assert distance(a, b) <= near_dedup.distance_at_most(x, y) <= max(len(a), len(b))
    long = np.arange(5000, dtype=np.uint64)
    other = np.concatenate([long[:1000] , long[1001:3000], np.arange(9000, 9100, dtype=np.uint64), long[3100:]])
    assert 101 <= near_dedup.distance_at_most(long, other) <= 110
    assert near_dedup.similar(long.astype(np.uint32), other.astype(np.uint32))


def words_of(texts):
    raw = [(t or "").lower().encode() for t in texts]
    words, counts = near_dedup.word_hashes(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]))
    ends = np.cumsum(counts)
    return words, counts, [words[e - n:e] for e, n in zip(ends, counts)]


def test_words_do_not_cross_texts():
    *_, split = words_of(["ab cd", "", "ab", "cd ab", "!!", None, "x_1 é"])
    assert [len(s) for s in split] == [2, 1, 1, 2, 1, 1, 2]
    assert split[0][0] == split[2][0] == split[3][1] and split[0][1] == split[3][0] and split[1][0] == split[5][0] != split[4][0]


def test_keys_keep_text_order():
    a, b = "a b c d e f g h i j k l m n o p".split(), "q r s t u v w x y z 1 2 3 4 5 6".split()
    words, counts, _ = words_of([" ".join(a + b), " ".join(b + a), " ".join(a + b)])
    keys = near_dedup.sketches(words, counts, 30)
    assert (keys[0] == keys[2]).all()
    assert 0 < (keys[0][::3] != keys[1][::3]).mean()


def brute_groups(rows):
    *_, split = words_of([r[1] for r in rows])
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            if find(i) != find(j) and near_dedup.similar(split[i], split[j]):
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for k in range(len(rows)):
        groups[find(k)].append(rows[k][0])
    return Counter(tuple(sorted(g, key=order)) for g in groups.values())


def test_near_groups(spark, docs, rows, no_docs):
    found = near_dedup.near_groups(docs).collect()
    groups = defaultdict(list)
    for r in found:
        groups[bytes(r["root"])].append(r["doc_id"])
    assert Counter(tuple(sorted(g, key=order)) for g in groups.values()) == brute_groups(rows)
    rows_found = near_dedup.near_duplicates(docs).collect()
    assert len(rows_found) == len(rows) and sum(r["kept"] for r in rows_found) == len(groups)
    kept = near_dedup.near_dedup(docs)
    assert kept.schema == docs.schema and kept.count() == len(groups)
    # rows from no file are stored first
    made = spark.createDataFrame([(1, "a b c d e f g"), (2, "A b c, d e f g"), (3, None)], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in near_dedup.near_dedup(made).collect()) == [1, 3]
    assert sum(r["kept"] for r in near_dedup.near_duplicates(made).collect()) == 2
    assert near_dedup.near_duplicates(no_docs).count() == 0


def test_rows_without_a_place_in_a_file(spark, docs):
    """An aggregation's rows have files below them, but no place of their own."""
    made = docs.distinct()
    assert near_dedup.near_dedup(made).count() == near_dedup.near_dedup(docs).count() > 0
    assert exact_dedup.exact_dedup_rows(made).count() == exact_dedup.exact_dedup_rows(docs).count() > 0


def test_exact_dedup_of_rows(spark, docs, rows):
    kept = exact_dedup.exact_dedup_rows(docs)
    assert kept.schema == docs.schema
    assert Counter(map(tuple, kept.collect())) == Counter(map(tuple, exact_dedup.exact_dedup(spark, source_of(docs), docs.schema).collect()))
    weak = exact_dedup.exact_dedup_rows(docs, few, files_per_trigger=1)
    assert Counter(map(tuple, weak.collect())) == Counter(map(tuple, kept.collect()))


def test_near_stores_no_words(spark, docs, monkeypatch):
    made, store = {}, near_dedup.stored_table

    def watched(df, name, folders=None):
        made[name] = df.columns
        return store(df, name, folders)

    monkeypatch.setattr(near_dedup, "stored_table", watched)
    near_dedup.near_groups(docs)
    assert {"sketches", "texts", "pairs"} <= set(made)
    assert not any({"words", "text"} & set(columns) for columns in made.values()), made


def test_near_recall_on_given_documents(spark):
    """All groups of the given documents, brute force over pairs that share a rare word."""
    path = "/root/testdata/sf0.001/documents.parquet"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(path).collect()]
    groups = defaultdict(list)
    for r in near_dedup.near_duplicates(spark.read.parquet(path)).collect():
        groups[r["group_id"]].append(r["doc_id"])
    assert Counter(tuple(sorted(g)) for g in groups.values()) == brute_groups(rows)


@pytest.mark.parametrize("settings", [{}, {"block": 40}])
def test_near_pairs_among_many_with_one_passage(spark, settings):
    """Strangers that share a long passage: the near pairs among them have no other five words in common."""
    rng = random.Random(12)

    def own(n):
        return [f"w{rng.randrange(10 ** 9)}" for _ in range(n)]

    passage, texts = own(300), []
    for k in range(220):
        words = own(90)
        texts.append(words + passage)
        if k % 11 == 0:  # every fifth word is another; the copy of the copy is too far from the first
            for start in (0, 1, 2):
                words = [f"c{rng.randrange(10 ** 9)}" if j % 5 == start else w for j, w in enumerate(words)]
                texts.append(words + passage)
            words = [w if j % 5 else "x" for j, w in enumerate(words)]
            texts.append(words + passage + own(40))
    rng.shuffle(texts)
    rows = [(k, " ".join(t)) for k, t in enumerate(texts)]
    expected = brute_groups(rows)
    assert sum(len(g) > 2 for g in expected) == 20
    groups = defaultdict(list)
    for r in near_dedup.near_groups(spark.createDataFrame(rows, "doc_id long, text string"), **settings).collect():
        groups[bytes(r["root"])].append(r["doc_id"])
    assert Counter(tuple(sorted(g)) for g in groups.values()) == expected


@pytest.mark.parametrize("settings", [{}, {"block": 60}])
def test_a_large_group_around_the_threshold_gives_links_not_pairs(spark, monkeypatch, settings):
    """Copies of one text that are alike by some 0.75 to 0.85: buckets with many candidates align inside and give fewer links than members."""
    rng = random.Random(31)
    base = [f"w{rng.randrange(10 ** 9)}" for _ in range(120)]
    rows = []
    for k in range(200):
        words = list(base)
        for j in rng.sample(range(120), rng.randrange(9, 19)):
            words[j] = f"c{rng.randrange(10 ** 9)}"
        rows.append((k, " ".join(words)))
    made = {}
    store = near_dedup.stored_table

    def counted(df, name, folders=None):
        table = store(df, name, folders)
        made[name] = made.get(name, 0) + table.count()
        return table

    monkeypatch.setattr(near_dedup, "stored_table", counted)
    groups = defaultdict(list)
    for r in near_dedup.near_groups(spark.createDataFrame(rows, "doc_id long, text string"), **settings).collect():
        groups[bytes(r["root"])].append(r["doc_id"])
    assert Counter(tuple(sorted(g)) for g in groups.values()) == brute_groups(rows)
    assert made["pairs"] < 10 * len(rows), made


def test_recall_of_planted_copies(spark):
    """Copies with words replaced all over the text, at the given similarity; short texts with one word changed in the middle."""
    rng = random.Random(21)
    texts, expected = [], {}
    for percent in (80, 85, 90, 95):
        for k in range(300):
            words = [f"w{rng.randrange(10 ** 9)}" for _ in range(rng.choice([20, 60, 100, 240]))]
            copy = list(words)
            for j in rng.sample(range(len(words)), len(words) * (100 - percent) // 100):
                copy[j] = f"c{rng.randrange(10 ** 9)}"
            expected[(len(texts), len(texts) + 1)] = percent
            texts += [words, copy]
    for k in range(300):
        words = [f"w{rng.randrange(10 ** 9)}" for _ in range(5 + k % 5)]
        expected[(len(texts), len(texts) + 1)] = 0
        texts += [words, [*words[:len(words) // 2], "changed", *words[len(words) // 2 + 1:]]]
    groups = defaultdict(list)
    frame = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    for r in near_dedup.near_groups(frame).collect():
        groups[bytes(r["root"])].append(r["doc_id"])
    pairs = [tuple(sorted(g)) for g in groups.values() if len(g) > 1]
    assert all(p in expected for p in pairs)
    recall = {p: n / 300 for p, n in Counter(expected[p] for p in pairs).items()}
    print("recall", recall)
    assert min(recall[p] for p in (0, 80, 85, 90, 95)) >= 0.99


def test_components(spark):
    rng = random.Random(8)
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    root = {}

    def find(k):
        while root.setdefault(k, k) != k:
            k = root[k]
        return k

    for a, b in links:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {k: find(k) for a, b in links if a != b for k in (a, b)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- suffix ----------------------------------------------------------------------------------------------------------


def symbols(strings):
    return np.array([x for s in strings for x in [*(b + 1 for b in s), 0]] + [0, 0, 0], np.uint16)


@pytest.mark.parametrize("letters", [1, 2, 4, 256])
def test_induced_sorting_finds_repeats(letters):
    rng = random.Random(letters)
    for _ in range(150):
        strings = [bytes(rng.randrange(letters) for _ in range(rng.randrange(1, 30))) for _ in range(rng.randrange(1, 12))]
        strings += [rng.choice(strings)[rng.randrange(3):] or b"x" for _ in range(4)]
        length, seen, expected = rng.choice([1, 2, 3, 5, 8]), set(), []
        for s in strings:
            for k in range(len(s)):
                w = s[k:k + length]
                expected.append(len(w) == length and w in seen)
                seen.add(w)
            expected.append(False)
        found = induced.repeats(symbols(strings), length, rng.choice([100, 1 << 20]))
        assert found.tolist() == expected + [False] * 3


def test_common_prefixes_follow_the_queues():
    rng = random.Random(1)
    text = symbols([bytes(rng.randrange(97, 100) for _ in range(60)) for _ in range(50)])
    sorter = induced.Sorter(text, 4000)
    seeds = sorter.sorted_seeds()
    common = np.zeros(len(seeds), np.int64)
    common[1:] = sorter.common(seeds[:-1], seeds[1:])
    got = []
    sorter.induce(seeds, common, lambda places, values: got.append((places, values)))
    places, values = (np.concatenate(x) for x in zip(*got))
    assert sorted(places) == np.flatnonzero(text[:-3]).tolist()
    assert (values[1:] == sorter.common(places[:-1], places[1:])).all()
    # downwards: a suffix is larger than the one after it
    for a, b in zip(places[:-1].tolist(), places[1:].tolist()):
        n = int(sorter.common(np.array([a]), np.array([b]))[0])
        assert text[a + n] > text[b + n] or (text[a + n] == text[b + n] == 0)


def brute_removed(rows, length):
    """Rows in order; equal rows under one id count once."""
    seen, out = set(), {}
    for key in sorted({(order(i), i, t or "") for i, t in rows}, key=lambda k: (k[0], k[2])):
        text = key[2].encode()
        edge = np.zeros(len(text) + 1, int)
        for k in range(len(text) - length + 1):
            window = text[k:k + length]
            if window in seen:
                edge[k] += 1
                edge[k + length] -= 1
            seen.add(window)
        gone = np.cumsum(edge[:-1]) > 0
        out[key[1:]] = (len(text), int(gone.sum()), int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()),
                        hashlib.sha256(np.frombuffer(text, np.uint8)[~gone].tobytes()).hexdigest())
    return out


@pytest.mark.parametrize("settings", [{}, {"hot": 300, "queue_bytes": 3000}])
def test_repeated_strings_go(docs, rows, settings):
    # ids that several texts share are ordered by a hash: left to the next test
    count = Counter(r[0] for r in set((r[0], r[1]) for r in rows))
    plain = [(r[0], r[1]) for r in rows if count[r[0]] == 1]
    frame = docs.filter(docs.doc_id.isin([i for i, _ in plain]))
    found = suffix_dedup.without_repeats(frame, ["doc_id", "text"], **settings).collect()
    expected = brute_removed(plain, 100)
    assert len(found) == len(plain)
    for r in found:
        key = (r["_row"]["doc_id"], r["_row"]["text"] or "")
        assert (r["_bytes"], r["_removed"], r["_spans"], r["_sha256"]) == expected[key]


def test_shared_ids_and_long_texts(spark, docs, rows, no_docs, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 5000)
    kept = suffix_dedup.remove_repeats(docs)
    assert kept.schema == docs.schema
    found = kept.collect()
    assert len(found) == len(rows)
    assert Counter(r["doc_id"] for r in found) == Counter(r[0] for r in rows)
    assert all(r["n_chars"] == len(r["text"]) for r in found)
    assert suffix_dedup.remove_repeats(no_docs).count() == 0
    text = "0123456789" * 30
    pair = spark.createDataFrame([(1, text, *[None] * 7), (1, text, *[None] * 7), (2, "x" + text, *[None] * 7)], DOC)
    found = sorted(((r["_row"]["doc_id"], r["_removed"]) for r in suffix_dedup.without_repeats(pair, ["doc_id"]).collect()))
    assert found == [(1, 290), (1, 290), (2, 300)]


def test_windows_of_hot_kmers_do_not_fill_a_shard(spark, monkeypatch):
    """400 texts around one passage: equal windows at its edges are settled before the shards are sorted."""
    rng = random.Random(15)
    passage = prose(rng, 60)
    rows = [(k, "".join(rng.choices("abcdefgh", k=150)) + passage + "".join(rng.choices("abcdefgh", k=150))) for k in range(400)]
    sort = suffix_dedup._sort_shard

    def watched(length, queue_bytes):
        def run(batches):
            batches = list(batches)
            assert sum(b.num_rows for b in batches) < 5000, "a shard holds equal windows"
            yield from sort(length, queue_bytes)(batches)
        return run

    monkeypatch.setattr(suffix_dedup, "_sort_shard", watched)
    found = suffix_dedup.without_repeats(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id", "text"], hot=8000).collect()
    expected = brute_removed(rows, 100)
    assert len(found) == len(rows)
    for r in found:
        assert (r["_bytes"], r["_removed"], r["_spans"], r["_sha256"]) == expected[(r["_row"]["doc_id"], r["_row"]["text"])]


def test_a_long_text_in_parts_gives_the_same_windows(monkeypatch):
    rng = np.random.default_rng(3)
    raw = rng.integers(97, 101, 30_000).astype(np.uint8)
    offsets = np.array([0, len(raw)])
    whole = suffix_dedup.units_of(raw, offsets, 100)
    monkeypatch.setattr(suffix_dedup, "PIECE", 4096)
    monkeypatch.setattr(suffix_dedup, "slices", lambda offsets, most: [(0, 1)])
    seen = {}
    for lo, hi, a, b in suffix_dedup._pieces(offsets, 100):
        for _, begin, windows, kmer, _ in zip(*suffix_dedup.units_of(raw[a:b], np.clip(offsets, a, b) - a, 100)):
            for k in range(windows):
                assert seen.setdefault(a + begin + k, kmer) == kmer
    assert seen == {b + k: h for _, b, w, h, _ in zip(*whole) for k in range(w)}
