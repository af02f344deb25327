"""Language identification by interpolated Kneser-Ney character models."""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import columns

ORDER = 4
# About so many labelled documents per language are learned from; the choice is by hash of the id.
SAMPLE_DOCS = 1_500
# Characters handled at a time, so that memory does not depend on a text's length.
SLICE = 1_000_000
# Lengths at which the rejection threshold changes, and what is added to the worst cross-entropy seen.
LENGTHS = (0, 10, 30, 100, 300, 1_000)
MARGIN = 1.0
UNKNOWN = "und"

_NOT_LETTERS = re.compile(r"[\W\d_]+")
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def clean(text: str | None) -> str:
    """Letters in lower case, other runs as one blank, a blank at either end; empty without letters."""
    out = _NOT_LETTERS.sub(" ", text.lower()) if text else ""
    return f" {out.strip()} " if any(map(str.isalpha, out)) else ""


def gram_hashes(chars: np.ndarray) -> list[np.ndarray]:
    """For each order the hash of the n-gram ending at each character; 0 precedes the first."""
    out, grown = [], chars.astype(np.uint64) + np.uint64(1)
    base = grown
    for n in range(1, ORDER + 1):
        if n > 1:
            earlier = np.zeros_like(grown)
            earlier[1:] = out[-1][:-1]
            grown = earlier * _MULTIPLIER + base
        out.append(grown)
    return out


def mixed(hashes: np.ndarray) -> np.ndarray:
    """Spread a polynomial hash over all 64 bits."""
    x = hashes ^ (hashes >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def stream(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Characters of all texts, each after ORDER - 1 zeros, and where each text's own characters start."""
    gap = "\0" * (ORDER - 1)
    chars = np.frombuffer("".join(gap + t for t in texts).encode("utf-32-le", "replace"), dtype="<u4")
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    return chars, np.cumsum(lengths + ORDER - 1) - lengths


@dataclass
class Table:
    """Sorted n-gram hashes with one value per language."""

    keys: np.ndarray
    values: np.ndarray

    def get(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros((len(keys), self.values.shape[1]), dtype=np.float32)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where((self.keys[at] == keys)[:, None], self.values[at], np.float32(0))


@dataclass
class Model:
    languages: list[str]
    shares: list[Table]  # per order: discounted share of the n-gram among its context's
    backoffs: list[Table]  # per order: mass left to the lower order; none for contexts never seen
    floor: float  # probability of a character never seen
    limits: np.ndarray | None = None  # per length class: highest cross-entropy accepted

    def log_probs(self, grams: list[np.ndarray]) -> np.ndarray:
        """Natural log of each language's probability for n-grams given by their suffix hashes.

        ``grams[n - 1]`` ends at the character, ``grams[ORDER + n - 1]`` is the context before it.
        """
        p = np.full((len(grams[0]), len(self.languages)), self.floor, dtype=np.float64)
        for n in range(1, ORDER + 1):
            left = self.backoffs[n - 1].get(mixed(grams[ORDER + n - 2])) if n > 1 else self.backoffs[0].values[:1]
            seen = left > 0
            p = np.where(seen, self.shares[n - 1].get(mixed(grams[n - 1])) + left * p, p)
        return np.log(p).astype(np.float32)

    def cross_entropy(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Per text and language the mean negative log probability of a character; and the lengths."""
        total = np.zeros((len(texts), len(self.languages)))
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        for owners, parts, skip in _slices(texts):
            chars, starts = stream(parts)
            hashes = gram_hashes(chars)
            code, first, where = np.unique(hashes[-1], return_index=True, return_inverse=True)
            before = np.maximum(first - 1, 0)
            log_p = self.log_probs([h[first] for h in hashes] + [h[before] for h in hashes])
            ends = starts + np.array([len(t) for t in parts])
            starts = starts + skip
            bounds = np.stack([starts, ends], axis=1).ravel()
            for k in range(len(self.languages)):
                run = np.r_[0.0, np.cumsum(log_p[where, k], dtype=np.float64)][bounds]
                np.add.at(total[:, k], owners, run[0::2] - run[1::2])
        return total / np.maximum(lengths, 1)[:, None], lengths


def _slices(texts: list[str]) -> Iterator[tuple[list[int], list[str], np.ndarray]]:
    """Groups of whole texts or parts of long ones; a part begins with characters already scored."""
    owners, parts, skip, held = [], [], [], 0
    for i, text in enumerate(texts):
        for at in range(0, len(text), SLICE):
            back = min(at, ORDER - 1)
            owners.append(i)
            parts.append(text[at - back:at + SLICE])
            skip.append(back)
            held += len(parts[-1])
            if held >= SLICE:
                yield owners, parts, np.array(skip)
                owners, parts, skip, held = [], [], [], 0
    if owners:
        yield owners, parts, np.array(skip)


def _kneser_ney(grams: pd.DataFrame, languages: list[str]) -> Model:
    """Fit from the distinct n-grams of the highest order: language, characters as text, count."""
    where = {lang: k for k, lang in enumerate(languages)}
    shares, backoffs = [], []
    level = grams
    by_order = []
    for n in range(ORDER, 0, -1):
        by_order.append(level)
        # A lower-order n-gram counts once for every character found before it.
        lower = level.assign(gram=level["gram"].str[1:])
        level = lower.groupby(["lang", "gram"], as_index=False).agg(n=("n", "size"))
    alphabet = by_order[-1]["gram"].nunique() + 1
    for level in reversed(by_order):
        level = level[~level["gram"].str.endswith("\0")]
        n = len(level["gram"].iloc[0]) if len(level) else 1
        once, twice = (level["n"] == 1).sum(), (level["n"] == 2).sum()
        discount = once / (once + 2 * twice) if once and twice else 0.5
        context = level["gram"].str[:-1]
        total = level.groupby(["lang", context])["n"].transform("sum")
        kinds = level.groupby(["lang", context])["n"].transform("size")
        column = level["lang"].map(where).to_numpy()
        shares.append(_table(level["gram"], column, (level["n"] - discount) / total, len(languages)))
        left = _table(context, column, discount * kinds / total, len(languages))
        if n == 1:
            mass = np.zeros((1, len(languages)), dtype=np.float32)
            mass[0, column] = (discount * kinds / total).to_numpy()
            left = Table(np.zeros(1, np.uint64), np.where(mass > 0, mass, 1))
        backoffs.append(left)
    return Model(languages, shares, backoffs, 1.0 / alphabet)


def _table(grams: pd.Series, column: np.ndarray, values: pd.Series, width: int) -> Table:
    names = pd.Index(grams.unique())
    if not len(names):
        return Table(np.zeros(0, np.uint64), np.zeros((0, width), np.float32))
    out = np.zeros((len(names), width), dtype=np.float32)
    out[names.get_indexer(grams), column] = values.to_numpy()
    if len(names[0]) == 0:
        return Table(np.zeros(1, np.uint64), out)
    chars = np.frombuffer("".join(names).encode("utf-32-le"), dtype="<u4").reshape(len(names), -1)
    code = np.zeros(len(names), dtype=np.uint64)
    for k in range(chars.shape[1]):
        code = code * _MULTIPLIER + (chars[:, k].astype(np.uint64) + np.uint64(1))
    keys = mixed(code)
    order = np.argsort(keys)
    return Table(keys[order], out[order])


def _length_class(lengths: np.ndarray) -> np.ndarray:
    return np.searchsorted(LENGTHS, lengths, side="right") - 1


def split_of(id_col: Column) -> Column:
    """Remainder by which documents are held out; NULL for a NULL id."""
    return F.crc32(id_col.cast("string").cast("binary")) % 4


def fit(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    sample_docs: int = SAMPLE_DOCS, held_out: int = 2,
) -> Model:
    """Learn a model from the labelled documents that are not held out.

    About ``sample_docs`` per language are taken, by hash of the id; a fifth of them is
    kept back to calibrate rejection. Counting runs on Spark; the distinct n-grams of the
    sample, whose number that bound limits, make the model on the driver.
    """
    rows = columns(docs, doc_id=id_col, text=text_col, lang=lang_col).where(
        F.col("lang").isNotNull() & (split_of(F.col("doc_id")) != held_out)
    )
    sizes = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], [], [], 1.0)
    draw = (F.shiftrightunsigned(F.xxhash64("doc_id", F.lit("sample")), 11) / F.lit(float(2**53)))
    share = F.element_at(F.create_map(*itertools.chain.from_iterable(
        (F.lit(k), F.lit(min(1.0, sample_docs / n))) for k, n in sizes.items()
    )), F.col("lang"))
    sample = rows.withColumn("draw", draw / share).where("draw < 1")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, group in batch.groupby("lang"):
                texts = list(filter(None, map(clean, group["text"])))
                for _, parts, skip in _slices(texts):
                    chars, starts = stream(parts)
                    code, first, n = np.unique(gram_hashes(chars)[-1], return_index=True, return_counts=True)
                    keep = first >= ORDER - 1
                    first, n = first[keep], n[keep]
                    grid = chars[first[:, None] + np.arange(1 - ORDER, 1)]
                    joined = grid.astype("<u4").tobytes().decode("utf-32-le")
                    grams = [joined[i:i + ORDER] for i in range(0, len(joined), ORDER)]
                    kept = [k for k, g in enumerate(grams) if g[-1] != "\0"]
                    yield pd.DataFrame({
                        "lang": lang, "gram": [grams[k] for k in kept], "n": n[kept].astype(np.int64),
                    })

    grams = (
        sample.where("draw >= 0.2").mapInPandas(count, "lang string, gram string, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    )
    model = _kneser_ney(grams.sort_values(["lang", "gram"]), languages)
    model.limits = _limits(model, sample.where("draw < 0.2"))
    return model


def _limits(model: Model, calibration: DataFrame) -> np.ndarray:
    """Highest cross-entropy of the documents kept back, by length class, never rising with length."""

    def worst(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = list(filter(None, map(clean, batch["text"])))
            if texts:
                entropy, lengths = model.cross_entropy(texts)
                yield pd.DataFrame({"length": _length_class(lengths), "worst": entropy.min(axis=1)})

    rows = calibration.mapInPandas(worst, "length long, worst double").groupBy("length").agg(F.max("worst")).collect()
    limits = np.full(len(LENGTHS), -np.inf)
    for row in rows:
        limits[row[0]] = row[1]
    limits = np.maximum.accumulate(limits[::-1])[::-1]
    ends = limits[np.isfinite(limits)]
    return np.where(np.isfinite(limits), limits, ends[-1] if len(ends) else np.inf) + MARGIN


def identify(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", carry: bool = False,
) -> DataFrame:
    """Predict the language of every document from its whole text.

    The language with the lowest cross-entropy per character wins, ties going to the first
    name. Text that is NULL or has no letter is ``und`` with score 0. The score compares the
    winner with the others over at most 50 characters. ``rejected`` says that no model
    explains the text: it is ``und``, or its cross-entropy exceeds what was calibrated for
    its length. Repeated rows give a row each, an empty table none. With ``carry`` all
    columns of the input stay and only ``__rejected`` is added; else returns doc_id,
    lang_pred, score, cross_entropy, rejected.
    """
    def judge(texts: list) -> tuple[list, np.ndarray, np.ndarray, np.ndarray]:
        m = model
        cleaned = list(map(clean, texts))
        known = np.array([bool(t) and bool(m.languages) for t in cleaned], dtype=bool)
        names = [UNKNOWN] * len(texts)
        score, entropy, rejected = np.zeros(len(texts)), np.full(len(texts), np.nan), np.ones(len(texts), bool)
        if known.any():
            per, lengths = m.cross_entropy([t for t in cleaned if t and m.languages])
            best = per.argmin(axis=1)
            lowest = per[np.arange(len(best)), best]
            weight = np.exp((lowest[:, None] - per) * np.minimum(lengths, 50)[:, None])
            at = np.flatnonzero(known)
            for i, k in zip(at.tolist(), best.tolist()):
                names[i] = m.languages[k]
            score[at], entropy[at] = 1 / weight.sum(axis=1), lowest
            rejected[at] = lowest > m.limits[_length_class(lengths)]
        return names, score, entropy, rejected

    if carry:
        def add(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for texts in batches:
                yield pd.Series(judge([t if isinstance(t, str) else None for t in texts.tolist()])[3])

        return docs.withColumn("__rejected", F.pandas_udf(add, "boolean")(F.col(f"`{text_col}`")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            names, score, entropy, rejected = judge(batch["text"].tolist())
            yield pd.DataFrame({
                "doc_id": batch["doc_id"].astype("Int64"), "lang_pred": names, "score": score,
                "cross_entropy": entropy, "rejected": rejected,
            })

    rows = columns(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.mapInPandas(
        run, "doc_id long, lang_pred string, score double, cross_entropy double, rejected boolean"
    )
