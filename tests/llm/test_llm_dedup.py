"""Exact and near dedup against brute force, with nulls, long texts, ties, repeats and empty tables."""

import hashlib
import random
from collections import Counter

from haulbook.llm import exact_dedup, near_dedup

DOCS = "doc_id long, text string, _size int, source string"


def texts_of(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    base = [" ".join(rng.choices(words, k=rng.randint(3, 60))) for _ in range(25)]
    texts = base + base[:8] + [None, "", "  ", "a", "a", "A"]
    for text in base[:12]:
        changed = text.split()
        changed[rng.randrange(len(changed))] = "other"
        texts.append(" ".join(changed))
        texts.append(text + " " + rng.choice(words))
    long = " ".join(rng.choices(words, k=20_000))
    return texts + [long, long, long + " end", "x" * 70_000, "x" * 70_001]


def bag(text):
    words = (text or "").encode().lower().split()
    runs = [tuple(words[i:i + 5]) for i in range(len(words) - 4)] or ([tuple(words)] if words else [])
    return Counter(runs)


def brute_classes(rows):
    ids = [i for i, _ in rows]
    bags = {i: bag(t) for i, t in rows}
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both, either = sum((bags[a] & bags[b]).values()), sum((bags[a] | bags[b]).values())
            if not either or both / either >= 0.8:
                lo, hi = sorted((find(a), find(b)))
                root[hi] = lo
    return {i: find(i) for i in ids}


def test_exact_dedup_by_brute_force(frame):
    rows = [(i, t, i % 3, None) for i, t in enumerate(texts_of(1))]
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault(t or "", []).append(i)
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_dedup.exact_dedup(frame(DOCS, rows)).collect()}
    want = {i: (max(g), len(g), i == max(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for i in g}
    assert got == want
    kept = exact_dedup.without_copies(frame(DOCS, rows))
    assert kept.columns == ["doc_id", "text", "_size", "source"]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(max(g) for g in groups.values())


def test_exact_dedup_repeated_and_missing_ids(frame):
    rows = [(1, "a", 0, None), (1, "a", 0, None), (None, "a", 0, None), (None, "b", 0, None)]
    got = exact_dedup.exact_dedup(frame(DOCS, rows)).collect()
    assert sorted((str(r.doc_id), r.group_size) for r in got) == [("1", 3), ("1", 3), ("None", 1), ("None", 3)]
    assert sum(r.kept for r in got) == 2
    assert exact_dedup.exact_dedup(frame(DOCS, [])).count() == 0


def test_near_classes_by_brute_force(frame):
    rows = list(enumerate(texts_of(2)))
    want = brute_classes(rows)
    got = near_dedup.near_classes(frame(DOCS, [(i, t, 1, None) for i, t in rows])).collect()
    assert {r.doc_id: r.class_id for r in got} == want
    sizes = Counter(want.values())
    assert all(r.class_size == sizes[r.class_id] and r.kept == (r.doc_id == r.class_id) for r in got)
    left = near_dedup.without_near_copies(frame(DOCS, [(i, t, 1, None) for i, t in rows]))
    assert sorted(r.doc_id for r in left.collect()) == sorted(sizes)
    assert left.columns == ["doc_id", "text", "_size", "source"]


def test_near_classes_without_ids_or_rows(frame):
    rows = [(None, "one two three", 0, None), (4, "one two three", 0, None), (4, "one two three", 0, None), (5, "other", 0, None)]
    got = sorted((str(r.doc_id), r.class_id, r.class_size) for r in near_dedup.near_classes(frame(DOCS, rows)).collect())
    assert got == [("4", 4, 3), ("4", 4, 3), ("5", 5, 1), ("None", 4, 3)]
    assert near_dedup.near_classes(frame(DOCS, [])).count() == 0


def test_a_class_is_not_lost_to_another_that_shares_its_id(frame):
    a, b = "alpha beta gamma delta epsilon zeta", "one two three four five six seven"
    left = near_dedup.without_near_copies(frame(DOCS, [(1, a, 0, "x"), (0, b, 0, "y"), (1, b, 0, "z"), (None, a, 0, "n")]))
    assert sorted((r.doc_id, r.text) for r in left.collect()) == [(0, b), (1, a)]


def test_each_class_keeps_one_row_and_each_text_one_bag(frame, monkeypatch):
    text = " ".join(f"w{k}" for k in range(40))
    rows = [(None, text, 0, None)] * 30 + [(None, text + " end", 0, None)] * 30 + [(5, "other words", 0, None)] * 3
    seen = []
    verified = near_dedup.verified
    monkeypatch.setattr(near_dedup, "verified", lambda pairs, sets: seen.append(sets.count()) or verified(pairs, sets))
    got = near_dedup.near_classes(frame(DOCS, rows)).collect()
    assert sorted((str(r.class_id), r.class_size, r.kept) for r in got) == sorted([("None", 60, k == 0) for k in range(60)] + [("5", 3, k == 0) for k in range(3)])
    assert set(seen) == {2}


def test_recall_on_a_table(spark):
    """Classes against all pairs at 0.8 or more, by brute force over the given documents."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r.doc_id: r.class_id for r in near_dedup.near_classes(docs).collect()}
    want = brute_classes(rows)
    assert got == want and len(set(want.values())) < len(want)
