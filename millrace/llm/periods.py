"""Periodic runs of words: seeds by minimizers of several scales, extension by names of word blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import columns

MIN_WORDS = 12
# Shorter periods are found by comparing words at that distance; scales of minimizers begin here.
FIRST_SCALE = 32
# Words handled at a time; a longer document is handled alone.
BATCH_WORDS = 400_000

COLLAPSED = (
    "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
)


class Names:
    """Equal names for equal blocks of 2**k words; blocks that occur once are named -1.

    ``codes`` tells the words of different documents apart, so blocks never match across documents.
    """

    def __init__(self, codes: np.ndarray):
        self.n = len(codes)
        self.levels = [self._repeated(codes, np.arange(self.n))]
        while True:
            size, last = 1 << (len(self.levels) - 1), self.levels[-1]
            if 2 * size >= self.n:
                break
            at = np.flatnonzero((last[:-size] >= 0) & (last[size:] >= 0))
            both = last[at].astype(np.int64) * self.n + last[at + size]
            named = self._repeated(both, at)
            if named.max(initial=-1) < 0:
                break
            self.levels.append(named)

    def _repeated(self, values: np.ndarray, at: np.ndarray) -> np.ndarray:
        out = np.full(self.n, -1, dtype=np.int32)
        if len(values):
            order = np.argsort(values, kind="stable")
            ranked = values[order]
            fresh = np.r_[True, ranked[1:] != ranked[:-1]]
            group = np.cumsum(fresh) - 1
            often = np.diff(np.r_[np.flatnonzero(fresh), len(ranked)]) > 1
            out[at[order]] = np.where(often[group], group, -1)
        return out

    def common(self, a: np.ndarray, b: np.ndarray, back: bool) -> np.ndarray:
        """How many words agree from a[i] and b[i] on, or before them if ``back``.

        No block longer than the last level's recurs, so every size is tried once, from the largest.
        """
        length = np.zeros(len(a), dtype=np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            names, size = self.levels[level], 1 << level
            x, y = (a - length - size, b - length - size) if back else (a + length, b + length)
            live = np.flatnonzero((np.minimum(x, y) >= 0) & (np.maximum(x, y) + size <= self.n))
            x, y = x[live], y[live]
            length[live[(names[x] == names[y]) & (names[x] >= 0)]] += size
        return length


def _stretches(equal: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every stretch of true values of at least ``least``."""
    edges = np.flatnonzero(np.diff(np.r_[False, equal, False].view(np.int8)))
    start, end = edges[::2], edges[1::2]
    long = end - start >= least
    return start[long], end[long]


def _extended(names: Names, at: np.ndarray, lag: np.ndarray, least: int) -> np.ndarray:
    """Runs (start, end, period) grown from places whose word recurs ``lag`` words later."""
    before = names.common(at, at + lag, back=True)
    after = names.common(at, at + lag, back=False)
    start, end = at - before, at + after + lag
    held = end - start >= np.maximum(least, 2 * lag)
    return np.stack([start[held], end[held], lag[held]], axis=1)


def _sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """pick over every window of ``width`` values."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = pick(values[:-step], values[step:])
        done += step
    return values


def minimizers(names: np.ndarray, size: int, window: int, periodic: np.ndarray) -> np.ndarray:
    """Places of the smallest block of every window, all of them where it ties.

    Only blocks that recur and are not periodic count. The order of blocks depends on
    their words alone, so equal windows have their minima at equal places.
    """
    worst = np.iinfo(np.int64).max
    usable = (names >= 0) & ~periodic
    if not usable.any() or len(names) < window + size - 1:
        return np.zeros(0, dtype=np.int64)
    rank = (names.astype(np.int64) * 0x9E3779B1) % 0x7FFFFFFF  # one-to-one below the modulus: equal ranks are equal names
    order = np.where(usable, rank, worst)[: len(names) - size + 1]
    low = _sliding(order, window, np.minimum)
    # The largest minimum over the windows that hold a place; it is the place's own rank if one of them chose it.
    padded = np.r_[np.full(window - 1, -1), low, np.full(window - 1, -1)]
    chosen = _sliding(padded, window, np.maximum) == order
    return np.flatnonzero(chosen & usable[: len(order)])


def _seeds(names: np.ndarray, at: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of equal minimizers at a distance from ``scale`` to twice that."""
    order = np.lexsort((at, names[at]))
    at = at[order]
    places, lags = [], []
    step = 1
    while step < len(at):
        first, second = at[:-step], at[step:]
        lag = second - first
        near = (names[first] == names[second]) & (lag < 2 * scale)
        if not near.any():
            break
        wide = near & (lag >= scale)
        places.append(first[wide])
        lags.append(lag[wide])
        step += 1
    if not places:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(places), np.concatenate(lags)


def _across(codes: np.ndarray, runs: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Seeds where one period is itself periodic: two touching runs of one shorter period.

    A run whose windows hold no usable block lies with its first period in one run of a short
    period d and with its second in the next run of d; its own period then follows from
    the phase between the two.
    """
    short = runs[(runs[:, 2] <= scale // 4) & (runs[:, 1] - runs[:, 0] >= scale)]
    short = short[np.lexsort((short[:, 0], short[:, 2]))]
    one, two = short[:-1], short[1:]
    touch = (one[:, 2] == two[:, 2]) & (two[:, 0] <= one[:, 1]) & (two[:, 1] - one[:, 0] >= 2 * scale)
    places, lags = [], []
    for (start, end, d), (begin, stop, _) in zip(one[touch].tolist(), two[touch].tolist()):
        root = codes[end - d:end]
        ahead = np.lib.stride_tricks.sliding_window_view(codes[begin:begin + 2 * d - 1], d)
        phase = np.flatnonzero((ahead == root).all(axis=1))
        if not len(phase):
            continue
        lag = np.arange((begin + int(phase[0]) - end) % d, 2 * scale, d)
        lag = lag[lag >= scale]
        # The border between the first two periods has to lie in both runs, a whole period from either far end.
        border = np.maximum(begin, start + lag)
        held = border <= np.minimum(end, stop - lag)
        places.append((border - lag)[held])
        lags.append(lag[held])
    if not places:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(places), np.concatenate(lags)


def _primitive(runs: np.ndarray) -> np.ndarray:
    """Distinct runs; of equal stretches the one of smallest period, which divides the others."""
    if not len(runs):
        return runs
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    fresh = np.r_[True, (runs[1:, :2] != runs[:-1, :2]).any(axis=1)]
    return runs[fresh]


def find_runs(codes: np.ndarray, least: int = MIN_WORDS, first_scale: int = FIRST_SCALE) -> np.ndarray:
    """All runs of a sequence as rows (start, end, period), by start, then period.

    A run is a stretch of at least ``least`` words and two periods that no neighbouring word
    extends. Periods below ``first_scale`` are found by comparing words at that distance.
    For periods from P to 2P, P doubling, blocks of P/2 words are named and every window of P/2 blocks picks
    its smallest one. The two windows a period apart inside a run hold the same words, so
    they pick blocks a period apart: equal blocks picked at such a distance seed an extension. Blocks
    with a period of at most P/4 are never picked, so a block has few equals near by; runs
    made of such blocks alone are seeded from the shorter runs.
    """
    if first_scale % 4 or first_scale < 2 * least or first_scale & (first_scale - 1):
        raise ValueError("the first scale is a power of two of at least twice the shortest run")
    n = len(codes)
    found = [np.zeros((0, 3), dtype=np.int64)]
    for lag in range(1, min(first_scale, n // 2 + 1)):
        start, end = _stretches(codes[:-lag] == codes[lag:], max(lag, least - lag))
        found.append(np.stack([start, end + lag, np.full(len(start), lag)], axis=1))
    runs = _primitive(np.concatenate(found))
    if n >= 2 * first_scale:
        names = Names(codes)
        scale = first_scale
        while 2 * scale <= n:
            level = scale.bit_length() - 2
            if level >= len(names.levels):
                break  # no block of this size recurs, nor do longer ones
            blocks, size = names.levels[level], scale // 2
            short = runs[(runs[:, 2] <= size // 2) & (runs[:, 1] - runs[:, 0] >= size)]
            steps = np.zeros(n + 1, dtype=np.int64)
            np.add.at(steps, short[:, 0], 1)
            np.add.at(steps, short[:, 1] - size + 1, -1)
            picked = minimizers(blocks, size, size, np.cumsum(steps[:-1]) > 0)
            seeds = [_seeds(blocks, picked, scale), _across(codes, runs, scale)]
            at, lag = (np.concatenate(x) for x in zip(*seeds))
            if len(at):
                runs = _primitive(np.concatenate([runs, _extended(names, at, lag, least)]))
            scale *= 2
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words that no run holds after its first period, joined by blanks."""
    if not len(runs):
        return b" ".join(words)
    steps = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(steps, runs[:, 0] + runs[:, 2], 1)
    np.add.at(steps, runs[:, 1], -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(steps[:-1]) == 0).tolist()])


def _batch_runs(texts: list[list[bytes]], least: int, first_scale: int) -> list[np.ndarray]:
    """Runs of every document of a batch, found in one sequence that keeps documents apart."""
    sizes = np.array([len(words) for words in texts], dtype=np.int64)
    ends = np.cumsum(sizes)
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for words in texts for w in words), np.int64, int(sizes.sum()))
    codes = ids + np.repeat(np.arange(len(texts)), sizes) * max(len(seen), 1)
    runs = find_runs(codes, least, first_scale)
    owner = np.searchsorted(ends, runs[:, 0], side="right")
    cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
    return [
        runs[a:b] - np.array([1, 1, 0]) * (end - size) for a, b, end, size in zip(cuts[:-1], cuts[1:], ends, sizes)
    ]


def collapse_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = MIN_WORDS,
    first_scale: int = FIRST_SCALE,
) -> DataFrame:
    """Every periodic run of words of every whole text, and the text without its repetitions.

    Words stand between ASCII blanks and are numbered from 0. A run is a stretch of words with
    smallest period q, ``least`` words or more and two periods or more long, that no neighbouring word
    extends; runs come by start, then period. A word goes if any run holds it after that run's
    first q words; the others are joined by one blank each.

    A NULL or empty text has no words, no runs and an empty rest. Repeated rows and rows without
    id give a row each, an empty table none; further columns are ignored. Nothing is shuffled; a
    task holds a batch of words, or one longer document. Returns doc_id, n_words, runs, collapsed.
    """

    def rows_of(ids: pa.Array, texts: list[list[bytes]]) -> pa.RecordBatch:
        found = _batch_runs(texts, least, first_scale)
        starts = np.cumsum([0] + [len(r) for r in found], dtype=np.int32)
        flat = np.concatenate(found) if found else np.zeros((0, 3), dtype=np.int64)
        runs = pa.StructArray.from_arrays(
            [pa.array(flat[:, 0]), pa.array(flat[:, 1] - flat[:, 0]), pa.array(flat[:, 2])], ["start", "length", "period"]
        )
        return pa.RecordBatch.from_arrays([
            ids, pa.array([len(words) for words in texts], pa.int64()),
            pa.ListArray.from_arrays(pa.array(starts), runs),
            pa.array([collapsed(words, r).decode() for words, r in zip(texts, found)], pa.string()),
        ], ["doc_id", "n_words", "runs", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, held, first = batch.column("doc_id"), [], 0, 0
            for at, text in enumerate(batch.column("text")):
                words = (text.as_py() or "").encode().split()
                if texts and held + len(words) > BATCH_WORDS:
                    yield rows_of(ids[first:at], texts)
                    texts, held, first = [], 0, at
                texts.append(words)
                held += len(words)
            if texts:
                yield rows_of(ids[first:], texts)

    rows = columns(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.mapInArrow(run, COLLAPSED)


def repeated_tails(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and text, where one document of ten has a tail of its words replaced by repeats of their first ones.

    The checksum of the decimal id chooses the documents, where the tail begins and the period.
    Rows without id or words stay as they are.
    """
    rows = columns(docs, doc_id=id_col, text=text_col)
    checksum = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"))
    g, n = F.expr("__h div 10"), F.size("__words")
    a = g % n
    p = F.expr("1 + (size(__words) - __a) div (3 + (__h div 10) % 8)")
    tail = F.transform(
        "__words",
        lambda w, i: F.when(i < F.col("__a"), w).otherwise(F.get("__words", (F.col("__a") + (i - F.col("__a")) % F.col("__p")).cast("int"))),
    )
    chosen = rows.withColumn("__h", checksum).withColumn("__words", F.when(F.col("__h") % 10 == 0, words))
    placed = chosen.withColumn("__a", F.when(n > 0, a)).withColumn("__p", p)
    return placed.select("doc_id", F.coalesce(F.when(F.col("__a").isNotNull(), F.array_join(tail, " ")), "text").alias("text"))
