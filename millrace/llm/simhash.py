"""Near duplicates by SimHash: a self-join of binary tries under a Hamming budget."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import ROW, columns, tasks_for, with_row
from millrace.operators.components import components
from millrace.session import pin

WORDS = 3
SEED = 42
BITS = 3
# Fingerprints that one subtree of a task may hold before tasks take deeper subtrees.
SUBTREE = 50_000
# Shingle hashes turned into bits at a time, and node pairs below which leaves are compared at once.
SLICE = 65_536
LEAVES = 32


def fingerprint(text: str | None, words: int = WORDS, seed: int = SEED) -> int:
    """64-bit SimHash of the text's word shingles after lower-casing A-Z, repeats included."""
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return 0
    size = min(words, len(tokens))
    ones, n = np.zeros(64, dtype=np.int64), len(tokens) - size + 1
    for at in range(0, n, SLICE):
        part = tokens[at:at + SLICE + size - 1]
        shingles = map(b" ".join, zip(*[part[k:] for k in range(size)]))
        hashes = np.fromiter((xxhash.xxh64_intdigest(s, seed) for s in shingles), dtype=">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int, seed: int, text: str = "text"):
    """The fingerprint column of a text column, as a signed long."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            prints = [fingerprint(t if isinstance(t, str) else None, words, seed) for t in texts.tolist()]
            yield pd.Series(np.array(prints, dtype=np.uint64).view(np.int64))

    return F.pandas_udf(run, "long")(F.col(f"`{text}`"))


# Inside a task: fingerprints are sorted, so a node of the trie is a range of positions.


def _roots(labels: np.ndarray) -> np.ndarray:
    while True:
        up = labels[labels]
        if np.array_equal(up, labels):
            return labels
        labels = up


def _merge(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Join the sets of a[i] and b[i]; labels point to the smallest position of a set."""
    while len(a):
        x, y = labels[a], labels[b]
        differ = x != y
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        if not len(a):
            break
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
        labels = _roots(labels)
    return labels


def _leaf_pairs(a: np.ndarray, an: np.ndarray, b: np.ndarray, bn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all leaf pairs of node pairs given by start and size."""
    n = an * bn
    pair = np.repeat(np.arange(len(n)), n)
    k = np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n)
    return a[pair] + k // bn[pair], b[pair] + k % bn[pair]


def trie_join(prints: np.ndarray, nodes: tuple, first_bits: int, budgets: tuple[int, int]) -> np.ndarray:
    """Set label of every fingerprint after joining all pairs within the budget.

    ``nodes`` are the node pairs to start from: start and size of either range, differing
    bits so far, and depth. Node pairs descend together bit by bit; a pair ends when its
    differing bits exceed the budget (``budgets[0]`` within the first ``first_bits``,
    ``budgets[1]`` in all) or when all its fingerprints are in one set already. Budgets are
    raised from 1, so that a crowd of near copies becomes one set before its many wider
    pairs would be listed.
    """
    labels = np.arange(len(prints))
    for budget in range(1, budgets[1] + 1):
        a, an, b, bn, differ, depth = (x.copy() for x in nodes)
        for level in range(64):
            if not len(a):
                break
            small = (an * bn <= LEAVES) & (depth <= level)
            if small.any():
                x, y = _leaf_pairs(a[small], an[small], b[small], bn[small])
                near = (x != y) & (np.bitwise_count(prints[x] ^ prints[y]) <= budget)
                labels = _merge(labels, x[near], y[near])
                a, an, b, bn, differ, depth = (v[~small] for v in (a, an, b, bn, differ, depth))
            if not len(a):
                break
            changes = np.r_[0, np.cumsum(labels[1:] != labels[:-1])]
            settled = (labels[a] == labels[b]) & (changes[a + an - 1] == changes[a]) & (changes[b + bn - 1] == changes[b])
            a, an, b, bn, differ, depth = (v[~settled] for v in (a, an, b, bn, differ, depth))
            ones = np.r_[0, np.cumsum((prints >> np.uint64(63 - level)) & np.uint64(1))].astype(np.int64)
            wait = depth > level
            a1, b1 = ones[a + an] - ones[a], ones[b + bn] - ones[b]
            a0, b0 = an - a1, bn - b1
            same = (a == b) & (an == bn)
            limit = min(budget, budgets[0]) if level < first_bits else budget
            new = [tuple(v[wait] for v in (a, an, b, bn, differ, depth))]
            for x, xn, y, yn, cost, live in (
                (a, a0, b, b0, 0, ~wait), (a + a0, a1, b + b0, b1, 0, ~wait),
                (a, a0, b + b0, b1, 1, ~wait), (a + a0, a1, b, b0, 1, ~wait & ~same),
            ):
                ok = live & (xn > 0) & (yn > 0) & (differ + cost <= limit)
                new.append(tuple(v[ok] for v in (x, xn, y, yn, differ + cost, depth)))
            a, an, b, bn, differ, depth = map(np.concatenate, zip(*new))
        else:
            if len(a):  # equal leaves after all bits
                x, y = _leaf_pairs(a, an, b, bn)
                labels = _merge(labels, x, y)
    return labels


def _links_of_task(frame: pd.DataFrame, depth: int, first_bits: int, budgets: tuple[int, int]) -> pd.DataFrame:
    """Links that hold the sets of one task together, one fewer than a set has members."""
    frame = frame.sort_values(["pair", "print_u"], kind="stable")
    prints = frame["print_u"].to_numpy()
    pair = frame["pair"].to_numpy()
    side = (prints >> np.uint64(64 - depth)) if depth else np.zeros(len(prints), np.uint64)
    fresh = np.r_[True, (pair[1:] != pair[:-1]) | (side[1:] != side[:-1])]
    start = np.flatnonzero(fresh)
    size = np.diff(np.r_[start, len(prints)])
    owner = pair[start]
    # Consecutive nodes of one pair meet each other; a node paired with itself stands alone.
    met = np.flatnonzero(owner[1:] == owner[:-1])
    own = frame["own"].to_numpy()[start]
    alone = np.flatnonzero(own)
    a = np.r_[start[met], start[alone]]
    an = np.r_[size[met], size[alone]]
    b = np.r_[start[met + 1], start[alone]]
    bn = np.r_[size[met + 1], size[alone]]
    differ = np.r_[np.ones(len(met), np.int64), np.zeros(len(alone), np.int64)]
    nodes = (a, an, b, bn, differ, np.full(len(a), depth))
    labels = trie_join(prints, nodes, first_bits, budgets)
    member = np.flatnonzero(labels != np.arange(len(labels)))
    ids = frame["print"].to_numpy()
    out = pd.DataFrame({"u": ids[labels[member]], "v": ids[member]})
    return out[out["u"] != out["v"]].drop_duplicates()


def _turned(prints: np.ndarray, by: int) -> np.ndarray:
    return prints if not by else (prints << np.uint64(by)) | (prints >> np.uint64(64 - by))


def near_links(prints: DataFrame, bits: int = BITS, subtree: int = SUBTREE) -> DataFrame:
    """Links (u, v) under which distinct fingerprints within ``bits`` bits are connected.

    Of the two halves of a fingerprint one differs in at most ``bits // 2`` bits, so the
    trie is walked twice, once with either half on top and that budget for it. Its top
    levels are dealt to tasks: a fingerprint goes to its own subtree and to the subtrees
    one bit away, as deep as it takes for every subtree to stay below ``subtree``
    fingerprints. Whole pairs of subtrees meet in a task; sets come back as links.
    """
    if bits // 2 > 1:
        raise ValueError("subtrees are dealt for budgets of up to 3 bits")
    total = prints.count()
    links = None
    for by in (0, 32):
        value = F.col("print") if not by else F.shiftleft("print", 32).bitwiseOR(F.shiftrightunsigned("print", 32))
        turned = prints.select("print", value.alias("turned"))
        depth = 0
        while depth < 32:
            node = F.shiftrightunsigned("turned", 64 - depth) if depth else F.lit(0).cast("long")
            largest = turned.groupBy(node.alias("node")).count().agg(F.max("count")).first()[0] or 0
            if largest <= subtree:
                break
            depth += 4
        own = F.shiftrightunsigned("turned", 64 - depth) if depth else F.lit(0).cast("long")
        budget = bits // 2
        near = [own.bitwiseXOR(F.lit(1 << k).cast("long")) for k in range(depth)] if budget else []
        # A pair of subtrees is named by the smaller one and the bit in which they differ, 63 for none.
        names = [F.struct(F.least(own, x).alias("low"), F.lit(k).alias("bit")) for k, x in enumerate(near)]
        names.append(F.struct(own.alias("low"), F.lit(63).alias("bit")))
        dealt = turned.select("print", "turned", F.inline(F.array(*names)))
        tasks = tasks_for(prints, total * (depth + 1), 1_000_000)
        dealt = dealt.repartition(tasks, "low", "bit")

        def run(batches: Iterator[pd.DataFrame], depth: int = depth, budget: int = budget) -> Iterator[pd.DataFrame]:
            held = [b for b in batches if len(b)]
            if held:
                frame = pd.concat(held, ignore_index=True)
                frame["print_u"] = frame["turned"].to_numpy().view(np.uint64)
                frame["pair"] = frame["low"] * 64 + frame["bit"]
                frame["own"] = frame["bit"] == 63
                yield _links_of_task(frame, depth, 32, (budget, bits))

        found = dealt.mapInPandas(run, "u long, v long")
        links = found if links is None else links.unionByName(found)
    return links


def mark_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, seed: int = SEED,
    bits: int = BITS,
) -> DataFrame:
    """Fingerprint and component of every document.

    Words are what stands between ASCII blanks after lower-casing A-Z; a text of fewer
    words than a shingle is one shingle, a text without words (NULL, empty) has
    fingerprint 0 and is linked like any other. Fingerprints link at ``bits`` or fewer
    differing bits; component_id is the smallest doc_id reachable, NULL only if every
    document of the component lacks an id. Equal fingerprints are one node, so copies are
    never expanded into pairs. Repeated rows give a row each, an empty table none; further
    columns are ignored. Returns doc_id, fingerprint (16 hex digits), component_id.
    """
    rows = pin(columns(docs, doc_id=id_col, text=text_col).select(
        "doc_id", fingerprints(docs, words, seed).alias("print")
    ))
    return with_components(rows, bits).select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )


def with_components(rows: DataFrame, bits: int = BITS) -> DataFrame:
    """Add component_id to pinned rows of doc_id and print."""
    nodes = pin(rows.groupBy("print").agg(F.min("doc_id").alias("first")))
    roots = pin(components(near_links(nodes.select("print"), bits)))
    placed = nodes.join(roots, nodes["print"] == roots["node"], "left").select(
        "print", "first", F.coalesce("root", "print").alias("root")
    )
    firsts = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    known = pin(placed.join(firsts, "root").select("print", "component_id"))
    return rows.join(known, "print")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS) -> DataFrame:
    """One document of each component, with all its columns: the smallest id, the first of repeated rows."""
    numbered = pin(with_row(docs).withColumn("__print", fingerprints(docs, WORDS, SEED, text_col)))
    rows = numbered.select(F.col(f"`{id_col}`").alias("doc_id"), ROW, F.col("__print").alias("print"))
    placed = pin(with_components(rows, bits).select("component_id", "doc_id", ROW, "print"))
    # Components whose documents all lack an id are told apart by their print.
    group = F.struct("component_id", F.when(F.col("component_id").isNull(), F.col("print")).alias("print"))
    kept = placed.groupBy(group.alias("group")).agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", ROW)).alias("best")
    ).select(F.col(f"best.{ROW}").alias(ROW))
    gone = pin(placed.join(kept, ROW, "left_anti").select(ROW))
    return numbered.join(gone, ROW, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
