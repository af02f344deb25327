"""Benchmark decontamination: rare n-gram seeds find passages, local alignment scores them."""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import columns

SEED_WORDS = 3
# Every n-gram that makes up no more than this share of the corpus is a seed ...
RARE_SHARE = 1e-6
RARE_LEAST = 20
# ... and of so many consecutive n-grams of an item the one whose words are rarest, however common it is.
SPREAD = 4
# Share of the best possible alignment score from which a passage counts as a copy.
THRESHOLD = 0.6
# Bytes of test items handed to all tasks at a time; a larger benchmark is searched in parts.
PART_BYTES = 16 << 20
MATCH, MISS, GAP = 2, 1, 1
_WORDS = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return _WORDS.findall(text.lower()) if text else []


class Items:
    """Test items as word numbers, with their n-grams in a sorted array."""

    def __init__(self, items: list[tuple[int | None, str | None]], size: int = SEED_WORDS):
        self.size = size
        texts = [(name, words_of(text)) for name, text in items]
        texts = [(name, words) for name, words in texts if len(words) >= size]
        self.names = [name for name, _ in texts]
        self.vocabulary = {w: i for i, w in enumerate(sorted({w for _, words in texts for w in words}))}
        self.words = [np.array([self.vocabulary[w] for w in words], dtype=np.int64) for _, words in texts]
        self.grams = np.unique(np.concatenate([self.codes(w)[0] for w in self.words] or [np.zeros(0, np.int64)]))
        self.postings: dict[int, list[tuple[int, int]]] = {}
        self.least: list[int] = []

    def codes(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the n-grams without unknown words, and where they start."""
        n = len(words) - self.size + 1
        if n < 1:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        known = words >= 0
        ok = known[:n].copy()
        for k in range(1, self.size):
            ok &= known[k:n + k]
        at = np.flatnonzero(ok)
        code = words[at].astype(np.uint64)
        for k in range(1, self.size):  # exact up to two million words, beyond that a hash
            code = code * np.uint64(len(self.vocabulary)) + words[at + k].astype(np.uint64)
        return code.view(np.int64), at

    def number(self, text: str | None) -> np.ndarray:
        get = self.vocabulary.get
        return np.array([get(w, -1) for w in words_of(text)], dtype=np.int64)

    def found(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indices of the items' n-grams that a text holds, and where."""
        code, at = self.codes(words)
        if not len(code) or not len(self.grams):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        k = np.minimum(np.searchsorted(self.grams, code), len(self.grams) - 1)
        hit = self.grams[k] == code
        return k[hit], at[hit]

    def choose_seeds(self, grams: np.ndarray, words: np.ndarray, words_in_all: int) -> None:
        """Take the n-grams that are rare in the corpus, and of every SPREAD consecutive ones the one of rarest words.

        Words decide there, as the n-grams of a passage copied often are common, and those
        that an edited copy breaks would be preferred.
        """
        rare = max(RARE_LEAST, RARE_SHARE * words_in_all)
        commonness = np.log1p(words)
        postings = defaultdict(list)
        for i, item in enumerate(self.words):
            k, at = self.found(item)
            common = sum(commonness[item[j:len(k) + j]] for j in range(self.size))
            last = max(1, len(k) - SPREAD + 1)
            chosen = {s + int(np.argmin(common[s:s + SPREAD])) for s in range(last)}
            chosen = sorted(chosen.union(np.flatnonzero(grams[k] <= rare).tolist()))
            for c in chosen:
                postings[int(k[c])].append((i, int(at[c])))
            # An item with many seeds is not compared for a single one.
            self.least.append(2 if len(chosen) >= 8 else 1)
        self.postings = dict(postings)
        self.is_seed = np.zeros(len(self.grams), dtype=bool)
        self.is_seed[list(self.postings)] = True

    def matches(self, text: str | None, threshold: float) -> list[tuple]:
        """Best alignment of every item that reaches the threshold: name, score, first and last word."""
        words = self.number(text)
        k, at = self.found(words)
        seed = self.is_seed[k] if len(k) else np.zeros(0, bool)
        if not seed.any():
            return []
        hits = defaultdict(list)
        for code, p in zip(k[seed].tolist(), at[seed].tolist()):
            for item, q in self.postings[code]:
                hits[item].append((p, q))
        out = []
        for item, places in sorted(hits.items()):
            target, best = self.words[item], None
            for group in _near(places, len(target)):
                if len({q for _, q in group}) < self.least[item]:
                    continue
                low = max(0, group[0][0] - len(target))
                high = min(len(words), group[-1][0] + len(target) + self.size)
                score, first, last = align(target, words[low:high])
                score /= MATCH * len(target)
                if score >= threshold and (best is None or score > best[1]):
                    best = (self.names[item], score, low + first, low + last)
            if best:
                out.append(best)
        return out


def _near(places: list[tuple[int, int]], gap: int) -> Iterator[list[tuple[int, int]]]:
    group: list[tuple[int, int]] = []
    for place in sorted(places):
        if group and place[0] - group[-1][0] > gap:
            yield group
            group = []
        group.append(place)
    yield group


def _score(target: np.ndarray, words: np.ndarray) -> tuple[int, int]:
    """Best Smith-Waterman score and the place in ``words`` where it ends."""
    slope = GAP * np.arange(len(words))
    row = np.zeros(len(words), dtype=np.int64)
    best, end = 0, -1
    for word in target.tolist():
        diagonal = np.r_[0, row[:-1]] + np.where(words == word, MATCH, -MISS)
        row = np.maximum(np.maximum(diagonal, row - GAP), 0)
        row = np.maximum.accumulate(row + slope) - slope
        at = int(row.argmax())
        if row[at] > best:
            best, end = int(row[at]), at
    return best, end


def align(target: np.ndarray, words: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment: score, first and last word of the passage."""
    best, end = _score(target, words)
    if not best:
        return 0, 0, -1
    _, back = _score(target[::-1], words[:end + 1][::-1])
    return best, end - back, end


def _parts(items: DataFrame) -> Iterator[Items]:
    """The benchmark in parts of about PART_BYTES, each small enough to be handed to all tasks."""
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, math.ceil(size / PART_BYTES))
    for part in range(parts):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).distinct()
        yield Items(sorted(((r.item_id, r.text) for r in rows.collect()), key=lambda r: (r[0] is None, r)))


def _counts(docs: DataFrame, items: Items) -> tuple[np.ndarray, np.ndarray, int]:
    """Occurrences in the whole corpus of the items' n-grams, of their words, and of all words.

    As many rows as the items have n-grams and words.
    """
    n, v = len(items.grams), len(items.vocabulary)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(n + v + 1, dtype=np.int64)
        for batch in batches:
            for text in batch["text"].tolist():
                words = items.number(text)
                np.add.at(total, items.found(words)[0], 1)
                np.add.at(total, n + np.where(words < 0, v, words), 1)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"which": at, "n": total[at]})

    total = np.zeros(n + v + 1, dtype=np.int64)
    counted = docs.select("text").mapInPandas(run, "which long, n long")
    for row in counted.groupBy("which").agg(F.sum("n")).collect():
        total[row[0]] = row[1]
    return total[:n], total[n:-1], int(total[n:].sum())


def ready_items(docs: DataFrame, items: DataFrame, text_col: str, item_col: str, item_text: str) -> Iterator[Items]:
    for part in _parts(columns(items, item_id=item_col, text=item_text)):
        if part.names:
            part.choose_seeds(*_counts(columns(docs, text=text_col), part))
            yield part


def find_passages(
    docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """Passages of documents that copy a test item, also with words edited, left out or put in.

    Words are runs of letters, digits and underscores in lower case. An item's 3-grams that
    are rare in the corpus are seeds, and so is the one of rarest words of every four
    consecutive ones: six words in a row always hold a seed, however common they are. Around seeds the text is aligned with
    the item by Smith-Waterman; the score is its share of a perfect alignment. Items of
    fewer than three words and NULL texts match nothing. Items are handed to the tasks in
    parts of bounded size, so documents are not shuffled. Repeated documents and items with
    several ids give a row for each; further columns are ignored; an empty table on either
    side gives no rows. Returns doc_id, item_id, score, first_word, last_word, one row per
    document and item.
    """
    schema = "doc_id long, item_id long, score double, first_word long, last_word long"
    rows = columns(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    out = docs.sparkSession.createDataFrame([], schema)
    for part in ready_items(docs, items, text_col, item_col, item_text):

        def run(batches: Iterator[pd.DataFrame], part: Items = part) -> Iterator[pd.DataFrame]:
            for batch in batches:
                found = [
                    (None if doc is None or doc != doc else int(doc), *match)
                    for doc, text in zip(batch["doc_id"].tolist(), batch["text"].tolist())
                    for match in part.matches(text, threshold)
                ]
                done = pd.DataFrame(found, columns=[c.split()[0] for c in schema.split(", ")])
                yield done.astype({"doc_id": "Int64", "item_id": "Int64"})

        out = out.unionByName(rows.mapInPandas(run, schema))
    return out


def drop_contaminated(
    docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, text_col: str = "text",
    item_col: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """The documents without a copied passage, all columns kept; judged where they are read."""
    out = docs
    for part in ready_items(docs, items, text_col, item_col, item_text):
        out = out.where(_free_of(part, threshold)(F.col(f"`{text_col}`")))
    return out


def _free_of(part: Items, threshold: float):
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([not part.matches(t if isinstance(t, str) else None, threshold) for t in texts], dtype=bool)

    return F.pandas_udf(clean, "boolean")
