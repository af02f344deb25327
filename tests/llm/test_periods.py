"""Periodic runs against plain comparison of words at every distance."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from millrace.llm import periods
from millrace.llm.plans import QUERIES

SF = "/root/testdata/sf0.001"


def plain_runs(words, least=periods.MIN_WORDS):
    """Every lag compared over the whole sequence; a stretch counts at its smallest period."""
    smallest, n = {}, len(words)
    codes = np.unique(np.array(list(words), dtype=str), return_inverse=True)[1] if n else np.zeros(0, int)
    for q in range(1, n // 2 + 1):
        same = np.r_[False, codes[:-q] == codes[q:], False].astype(int)
        edges = np.flatnonzero(np.diff(same))
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if b - a + q >= max(least, 2 * q):
                smallest.setdefault((a, b + q), q)
    return sorted((s, e, q) for (s, e), q in smallest.items())


def fast(words, least=periods.MIN_WORDS, first=periods.FIRST_SCALE):
    names = {w: i for i, w in enumerate(dict.fromkeys(words))}
    codes = np.array([names[w] for w in words], dtype=np.int64)
    return sorted((s, e, q) for s, e, q in map(tuple, periods.find_runs(codes, least, first).tolist()))


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def nested(rng, depth):
    """Repetitions of repetitions with small changes: the hard cases of the method."""
    word = "".join(rng.choices("ab", k=rng.randint(1, 3)))
    for _ in range(depth):
        word = word * rng.randint(1, 4) + word[:rng.randint(0, len(word))]
        if rng.random() < 0.3:
            at = rng.randrange(len(word))
            word = word[:at] + rng.choice("abc") + word[at + 1:]
        word = word[:900]
    return word


@pytest.mark.parametrize("least,first", [(2, 4), (4, 8), (12, 32)])
def test_runs_by_brute_force(least, first):
    rng = random.Random(least)
    words = [fibonacci(n) for n in (0, 1, 2, 13, 60, 200, 700)] + ["a" * 500, "ab" * 300, "aab" * 90 + "b" + "aab" * 90]
    words += ["ab" * 40 + "a" + "ab" * 40 + "a" + "ab" * 41, ("a" * 70 + "b") * 5, ("ab" * 33 + "a") * 4]
    words += ["".join(rng.choices("ab", k=rng.randint(1, 120))) for _ in range(300)]
    words += [nested(rng, rng.randint(2, 6)) for _ in range(400)]
    words += ["".join(rng.choices("abcdefgh", k=150)) * 3 + "x" for _ in range(20)]
    for w in words:
        assert fast(w, least, first) == plain_runs(w, least), w


def test_every_place_and_period():
    rng = random.Random(3)
    for period in (1, 5, 31, 32, 33, 63, 64, 65, 127, 128, 200, 256, 511):
        root = [f"r{i}" for i in range(period)]
        for extra in (0, 1, period - 1):
            length = max(12, 2 * period + extra)
            run = (root * (length // period + 1))[:length]
            before = [f"b{rng.random()}" for _ in range(rng.randint(0, 50))]
            after = [f"a{rng.random()}" for _ in range(rng.randint(0, 50))]
            assert fast(before + run + after) == [(len(before), len(before) + length, period)]
            assert fast(before + run[:max(11, 2 * period - 1) if period > 5 else 11] + after) == []


def test_seeds_stay_few_in_periodic_texts():
    """Blocks with a short period are not picked, so equal picked blocks are few near by."""
    codes = np.array([ord(c) for c in "a" * 3000 + "b" + "a" * 3000 + "ab" * 2000], dtype=np.int64)
    runs, names = periods.find_runs(codes), periods.Names(codes)
    for level, scale in ((4, 32), (6, 128), (8, 512)):
        size = scale // 2
        short = runs[(runs[:, 2] <= size // 2) & (runs[:, 1] - runs[:, 0] >= size)]
        periodic = np.zeros(len(codes), bool)
        for s, e, _ in short.tolist():
            periodic[s:e - size + 1] = True
        picked = periods.minimizers(names.levels[level], size, size, periodic)
        at, _ = periods._seeds(names.levels[level], picked, scale)
        assert len(at) <= 8 * len(codes) // size


def rewritten(words, doc_id):
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def plain_row(doc_id, text):
    words = [w.decode() for w in (text or "").encode().split()]
    words = rewritten(words, doc_id)
    runs = plain_runs(words)
    gone = {i for s, e, q in runs for i in range(s + q, e)}
    best = min(runs, key=lambda r: (r[0] - r[1], r[0], r[2]), default=None)
    longest = (None,) * 4 if best is None else (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2])
    listed = "".join(f"{s},{e - s},{q}\n" for s, e, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *longest, *(hashlib.sha256(x.encode()).hexdigest() for x in (listed, kept)))


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r.doc_id: tuple(r) for r in QUERIES["op11_periodic_runs"].run(spark, SF).collect()}
    short = [r for r in docs if len(r.text.split()) < 4000]
    assert len(got) == len(docs) and len(short) > 0.9 * len(docs)
    assert {r.doc_id: got[r.doc_id] for r in short} == {r.doc_id: plain_row(r.doc_id, r.text) for r in short}
    assert sum(r[1] > 0 for r in got.values()) > len(docs) // 20


def test_awkward_rows(spark, awkward, empty, monkeypatch):
    tails = periods.repeated_tails(awkward)
    texts = sorted(((r.doc_id, " ".join((r.text or "").split())) for r in awkward.collect()), key=repr)
    want = sorted(((i, " ".join(rewritten(t.split(), i))) for i, t in texts), key=repr)
    assert sorted(((r.doc_id, " ".join((r.text or "").split())) for r in tails.collect()), key=repr) == want
    for words in (periods.BATCH_WORDS, 10):
        monkeypatch.setattr(periods, "BATCH_WORDS", words)
        rows = periods.collapse_runs(awkward).collect()
        assert len(rows) == awkward.count() and rows[0].asDict().keys() == {"doc_id", "n_words", "runs", "collapsed"}
        by_id = {r.doc_id: r for r in rows}
        assert (by_id[6].n_words, by_id[6].runs, by_id[6].collapsed) == (0, [], "")
        assert by_id[11].collapsed == "Orre" and [tuple(x) for x in by_id[11].runs] == [(0, 3000, 1)]
        assert [tuple(x) for x in by_id[10].runs] == [(0, 60_000, 977)]
    assert periods.collapse_runs(empty).count() == 0
    assert periods.collapse_runs(periods.repeated_tails(empty)).count() == 0


def test_ids_beyond_double_precision(spark):
    docs = spark.createDataFrame([(2**60 + 1, "a b"), (None, "c"), (2**60 + 3, None)], "doc_id long, text string")
    assert {r.doc_id for r in periods.collapse_runs(docs.repartition(1)).collect()} == {2**60 + 1, None, 2**60 + 3}
