"""Exact and near duplicates, components."""

import hashlib
import random
import string

import numpy as np
import pytest
import xxhash

from millrace.llm import exact, simhash
from millrace.operators.components import components

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def test_exact_marks(awkward):
    rows = awkward.collect()
    groups = {}
    for r in rows:
        groups.setdefault((r.text or "").translate(LOWER), []).append(r.doc_id)
    got = exact.mark_duplicates(awkward).collect()
    assert len(got) == len(rows)
    by_text = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for r in got:
        ids = by_text[r.text_sha256]
        assert r.group_size == len(ids)
        assert r.keep_id == max((i for i in ids if i is not None), default=None)
        assert not r.kept or r.doc_id == r.keep_id
    assert sum(r.kept for r in got) == len(groups)


@pytest.mark.parametrize("heavy", [1, 3, 1_000])
def test_exact_same_with_any_split(spark, monkeypatch, heavy):
    monkeypatch.setattr(exact, "HEAVY", heavy)
    rows = [(i, "hot" if i % 3 == 0 else f"t{i % 40}") for i in range(300)]
    got = exact.mark_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    best = {}
    for i, t in rows:
        best[t] = max(best.get(t, -1), i)
    text = dict(rows)
    assert sorted((r.doc_id, r.keep_id, r.kept) for r in got) == sorted((i, best[text[i]], best[text[i]] == i) for i, _ in rows)


def test_drop_duplicates_keeps_columns(awkward):
    out = exact.drop_duplicates(awkward)
    assert out.columns == awkward.columns
    assert out.count() == len({(r.text or "").translate(LOWER) for r in awkward.collect()})


def test_empty_tables(empty):
    assert exact.mark_duplicates(empty).count() == 0
    assert exact.drop_duplicates(empty).count() == 0
    assert simhash.mark_near_duplicates(empty).count() == 0
    assert simhash.drop_near_duplicates(empty).count() == 0


def plain_fingerprint(text):
    words = (text or "").translate(LOWER).encode().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def sets(n, links):
    label = list(range(n))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        label[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def test_simhash_rows(awkward):
    rows = awkward.collect()
    prints = [plain_fingerprint(r.text) for r in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3]
    labels = sets(len(rows), links)
    least = {}
    for r, s in zip(rows, labels):
        ids = [x for x in (least.get(s), r.doc_id) if x is not None]
        least[s] = min(ids, default=None)
    want = [(r.doc_id, f"{p:016x}", least[s]) for r, p, s in zip(rows, prints, labels)]
    got = [tuple(r) for r in simhash.mark_near_duplicates(awkward).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    kept = simhash.drop_near_duplicates(awkward)
    assert kept.columns == awkward.columns and kept.count() == len(set(labels))


@pytest.mark.parametrize("subtree", [4, 200, 50_000])
def test_trie_join_finds_every_component(spark, subtree):
    rnd = random.Random(5)
    prints = set()
    for _ in range(300):
        p = rnd.getrandbits(64)
        prints.add(p)
        for _ in range(rnd.randrange(4)):
            for _ in range(rnd.randrange(1, 6)):
                p ^= 1 << rnd.randrange(64)
            prints.add(p)
    crowd = rnd.getrandbits(64)  # many near copies of one text
    for _ in range(400):
        p = crowd
        for _ in range(rnd.randrange(4)):
            p ^= 1 << rnd.randrange(64)
        prints.add(p)
    prints = sorted(prints)
    value = np.array(prints, dtype=np.uint64)
    links = [(i, j) for i in range(len(prints)) for j in np.flatnonzero(np.bitwise_count(value[i] ^ value[:i]) <= 3)]
    want = sets(len(prints), links)
    frame = spark.createDataFrame([(int(x),) for x in value.view(np.int64)], "print long")
    at = {int(x): i for i, x in enumerate(value.view(np.int64))}
    pairs = [(at[r.u], at[r.v]) for r in simhash.near_links(frame, subtree=subtree).collect()]
    assert sets(len(prints), pairs) == want


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 80)] + [(5, 5), (500, 501), (501, 500)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = {i: 0 for i in range(80)} | {i: 100 for i in range(100, 161)} | {500: 500, 501: 500}
    assert got == want
