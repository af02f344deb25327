"""Frequent n-grams of token lists, counted block by block; no table of all n-grams is ever made."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import pin, unpin

# Tokens that a task holds at a time.
BLOCK_TOKENS = 1_000_000
# Terms a block reports first, for every term wanted.
REPORTED = 4
# Candidates that are sent to every task.
CANDIDATES = 1_000_000


def _token_blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.Table, np.ndarray, pa.Array, np.ndarray]]:
    """Rows of about ``size`` tokens: the rows, each token's row, the different words, each token's word."""
    held: list[pa.RecordBatch] = []
    n = 0

    def block():
        rows = pa.Table.from_batches(held)
        lists = rows.column("_tokens").combine_chunks()
        lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
        lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        words = lists.flatten().dictionary_encode()
        codes = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        return rows.drop_columns(["_tokens"]), np.repeat(np.arange(len(lengths)), lengths), words.dictionary.cast(pa.string()), codes

    for batch in batches:
        held.append(batch)
        n += len(batch.column("_tokens").flatten())
        if n >= size:
            yield block()
            held, n = [], 0
    if held:
        yield block()


def _local_counts(row: np.ndarray, words: pa.Array, codes: np.ndarray, low: int, high: int):
    """For every length: a place of each different n-gram, its count, and the n-gram of each (row, n-gram) once."""
    ids = codes
    base = max(len(words), 1)
    for n in range(1, high + 1):
        if n > 1:
            same = row[: len(row) - n + 1] == row[n - 1 :] if len(row) >= n else np.zeros(0, bool)
            at = np.flatnonzero(same)
            # Shorter ones of the same start are numbered by ``ids``, -1 where a row ends before.
            keys = ids[at] * base + codes[at + n - 1]
        else:
            at, keys = np.arange(len(codes)), codes
        _, first, inverse, counts = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
        size = max(len(counts), 1)
        if n >= low:
            pairs = np.sort(row[at] * size + inverse)
            pairs = pairs[np.r_[True, pairs[1:] != pairs[:-1]]] if len(pairs) else pairs
            yield n, at[first], counts, np.bincount(pairs % size, minlength=len(counts)).astype(np.int64)
        ids = np.full(len(codes), -1, np.int64)
        ids[at] = inverse


def _spelled(words: pa.Array, codes: np.ndarray, at: np.ndarray, n: int) -> pa.Array:
    parts = [words.take(pa.array(codes[at + i])) for i in range(n)]
    return parts[0] if n == 1 else pc.binary_join_element_wise(*parts, " ")


def _reports(df: DataFrame, low: int, high: int, block: int, top: int | None = None, floor: tuple[float, int] | None = None) -> DataFrame:
    """(term, total, df, slack) of each block: its ``top`` terms, or those of a proportional part of the
    total ``floor[0]`` over ``floor[1]`` tokens, or all. No term that a block leaves out occurs there more than
    ``slack`` times; a row with a NULL term carries each block's slack."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, row, words, codes in _token_blocks(batches, block):
            found = list(_local_counts(row, words, codes, low, high))
            slack = 0.0
            if floor is not None:
                slack = floor[0] * len(codes) / max(floor[1], 1)
            elif top is not None:
                every = np.concatenate([counts for _, _, counts, _ in found])
                slack = float(np.partition(every, len(every) - top - 1)[len(every) - top - 1]) if len(every) > top else 0.0
            for n, at, counts, df_ in found:
                # A term of just the slack may go: it occurs no more than that.
                kept = counts > slack
                yield pa.RecordBatch.from_arrays(
                    [_spelled(words, codes, at[kept], n), pa.array(counts[kept].astype(np.int64)), pa.array(df_[kept]),
                     pa.array(np.full(int(kept.sum()), slack))], ["term", "total", "df", "slack"],
                )
            yield pa.RecordBatch.from_arrays(
                [pa.array([None], pa.string()), pa.array([len(codes)]), pa.array([0]), pa.array([slack])], ["term", "total", "df", "slack"]
            )

    return df.select("_tokens").mapInArrow(run, "term string, total bigint, df bigint, slack double")


class _Known:
    """Places of given n-grams in blocks, by the numbers of their words."""

    def __init__(self, terms: Sequence[str]):
        split = [t.split(" ") for t in terms]
        self.high = max(map(len, split), default=1)
        words = sorted({w for parts in split for w in parts})
        number = {w: i + 1 for i, w in enumerate(words)}
        self.base = len(words) + 1
        if self.base**self.high >= 1 << 63:
            raise ValueError("too many words for one number per n-gram")
        self.words = pa.array(words, pa.string())
        keys = np.array([self._key([number[w] for w in parts]) for parts in split], np.int64)
        self.order = np.argsort(keys)
        self.keys = keys[self.order]

    def _key(self, numbers: Sequence[int]) -> int:
        out = 0
        for i in range(self.high):
            out = out * self.base + (numbers[i] if i < len(numbers) else 0)
        return out

    def counts(self, row: np.ndarray, words: pa.Array, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, term, count) of all given n-grams in the block, by row, then term."""
        if not len(self.keys) or not len(codes):
            return (np.zeros(0, np.int64),) * 3
        known = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        number = known[codes]
        at = np.flatnonzero(number)
        key, found = number[at], []
        for n in range(1, self.high + 1):
            if n > 1:
                inside = at + n - 1 < len(codes)
                at, key = at[inside], key[inside]
                goes = (row[at] == row[at + n - 1]) & (number[at + n - 1] > 0)
                at, key = at[goes], key[goes] * self.base + number[at[goes] + n - 1]
            whole = key * self.base ** (self.high - n)
            place = np.minimum(np.searchsorted(self.keys, whole), len(self.keys) - 1)
            hit = self.keys[place] == whole
            found.append(row[at[hit]] * len(self.keys) + self.order[place[hit]])
        pairs, counts = np.unique(np.concatenate(found), return_counts=True)
        return pairs // len(self.keys), pairs % len(self.keys), counts.astype(np.int64)


def block_totals(df: DataFrame, block: int = BLOCK_TOKENS, by: Sequence[str] = ()) -> DataFrame:
    """(by, term, total, df) of the single tokens of each block; ``df`` has one row per document."""
    by = list(by)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, row, words, codes in _token_blocks(batches, block):
            size = max(len(words), 1)
            group, firsts = _groups(rows, by)
            pairs, counts = np.unique(row * size + codes, return_counts=True)
            key = group[pairs // size] * size + pairs % size
            named, inverse = np.unique(key, return_inverse=True)
            total = np.bincount(inverse, weights=counts, minlength=len(named)).astype(np.int64)
            where = rows.take(pa.array(firsts[named // size])).combine_chunks() if len(named) else rows.slice(0, 0)
            arrays = [where.column(c).combine_chunks() for c in by]
            arrays += [words.take(pa.array(named % size)), pa.array(total), pa.array(np.bincount(inverse, minlength=len(named)).astype(np.int64))]
            yield pa.RecordBatch.from_arrays(arrays, [*by, "term", "total", "df"])

    kinds = "".join(f"`{c}` {df.schema[c].dataType.simpleString()}, " for c in by)
    return df.select(*by, "_tokens").mapInArrow(run, f"{kinds}term string, total bigint, df bigint")


def _groups(rows: pa.Table, by: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Number of each row's group, and a row of each group."""
    group = np.zeros(len(rows), np.int64)
    for c in by:
        values = rows.column(c).combine_chunks().dictionary_encode(null_encoding="encode")
        values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
        group = group * max(len(values.dictionary), 1) + values.indices.to_numpy(zero_copy_only=False)
    _, firsts, numbers = np.unique(group, return_index=True, return_inverse=True)
    return numbers.astype(np.int64), firsts


def known_totals(df: DataFrame, terms: Sequence[str], block: int = BLOCK_TOKENS) -> DataFrame:
    """(term, total, df) of the given n-grams in each block."""
    known, names = _Known(terms), pa.array(list(terms), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, row, words, codes in _token_blocks(batches, block):
            _, term, counts = known.counts(row, words, codes)
            total = np.bincount(term, weights=counts, minlength=len(names)).astype(np.int64)
            seen = np.flatnonzero(total)
            rows = np.bincount(term, minlength=len(names))[seen].astype(np.int64)
            yield pa.RecordBatch.from_arrays([names.take(pa.array(seen)), pa.array(total[seen]), pa.array(rows)], ["term", "total", "df"])

    return df.select("_tokens").mapInArrow(run, "term string, total bigint, df bigint")


def known_counts(df: DataFrame, keep: Sequence[str], terms: Sequence[str], weights: Sequence[float] | None = None, block: int = BLOCK_TOKENS) -> DataFrame:
    """(keep, term, tf) of the given n-grams of each row; with ``weights`` of the terms also ``weight``,
    tf times the term's, a row's of length one."""
    keep = list(keep)
    known, names = _Known(terms), pa.array(list(terms), pa.string())
    scale = None if weights is None else np.array(weights, float)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, row, words, codes in _token_blocks(batches, block):
            at, term, counts = known.counts(row, words, codes)
            arrays = [rows.column(c).combine_chunks().take(pa.array(at)) for c in keep] + [names.take(pa.array(term)), pa.array(counts)]
            if scale is not None:
                w = counts * scale[term]
                squares = np.bincount(at, weights=w * w, minlength=len(rows))
                arrays.append(pa.array(w / np.sqrt(squares[at])))
            yield pa.RecordBatch.from_arrays(arrays, [*keep, "term", "tf", *(["weight"] if scale is not None else [])])

    kinds = "".join(f"`{c}` {df.schema[c].dataType.simpleString()}, " for c in keep)
    return df.select(*keep, "_tokens").mapInArrow(run, f"{kinds}term string, tf bigint{', weight double' if weights is not None else ''}")


def held(terms: Sequence[str]) -> bool:
    """Whether one number per n-gram holds all of the terms."""
    split = [t.split(" ") for t in terms]
    return (len({w for parts in split for w in parts}) + 1) ** max(map(len, split), default=1) < 1 << 63


class TermCounts(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Vector of how often each n-gram of the vocabulary stands in a list of tokens; no other n-gram is spelled."""

    vocabularyTerms = Param(Params._dummy(), "vocabularyTerms", "the n-grams that are counted, words joined by spaces", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, vocabulary: Sequence[str] = (), inputCol: str | None = None, outputCol: str | None = None):
        super().__init__()
        self._set(vocabularyTerms=list(vocabulary), **{k: v for k, v in (("inputCol", inputCol), ("outputCol", outputCol)) if v})

    @property
    def vocabulary(self) -> list[str]:
        return self.getOrDefault(self.vocabularyTerms)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(self.getOutputCol(), _count_vectors(self.vocabulary)(F.col(self.getInputCol())))


def _count_vectors(terms: Sequence[str], block: int = BLOCK_TOKENS):
    known, size = _Known(terms), len(terms)

    @F.arrow_udf(VectorUDT())
    def vectors(lists: pa.Array) -> pa.Array:
        lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        ends, parts, at = np.cumsum(lengths, dtype=np.int64), [], 0
        while at < len(lists):
            before = ends[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(ends, before + block, side="right")))
            words = lists.slice(at, end - at).flatten().dictionary_encode()
            row = np.repeat(np.arange(end - at), lengths[at:end])
            found, term, counts = known.counts(row, words.dictionary.cast(pa.string()), words.indices.to_numpy(zero_copy_only=False).astype(np.int64))
            starts = pa.array(np.r_[0, np.cumsum(np.bincount(found, minlength=end - at))].astype(np.int32))
            parts.append(pa.StructArray.from_arrays(
                [
                    pa.array(np.zeros(end - at, np.int8)), pa.array(np.full(end - at, size, np.int32)),
                    pa.ListArray.from_arrays(starts, pa.array(term.astype(np.int32))),
                    pa.ListArray.from_arrays(starts, pa.array(counts.astype(np.float64))),
                ],
                ["type", "size", "indices", "values"], mask=lists.slice(at, end - at).is_null(),
            ))
            at = end
        return pa.concat_arrays(parts)

    return vectors


def candidates(
    df: DataFrame, ngram_range: tuple[int, int], wanted: int, min_df: float, max_df: float, surplus: int = 0,
    block: int = BLOCK_TOKENS, reported: int | None = None,
) -> list[str] | None:
    """Terms that hold every one of the ``wanted`` most frequent with ``min_df`` to ``max_df`` documents, ties included.

    Blocks report their own most frequent terms. Sums of reports are lower bounds of totals, so the
    ``wanted``-th largest sum is one of the total that a term needs. What a term may have in blocks that
    did not report it is at most their slack; terms that stay below with it are out. If an unreported
    term could still be in, blocks report again, all terms with their part of that total. ``surplus`` is by how
    much rows may exceed documents. None if more than ``CANDIDATES`` are left.
    """
    low, high = ngram_range
    floor: tuple[float, int] | None = None
    need = 0
    while True:
        reports = pin(_reports(df, low, high, block, top=None if floor else (reported or REPORTED * wanted), floor=floor))
        whole = reports.where("term IS NULL").agg(F.sum("slack").alias("slack"), F.sum("total").alias("tokens")).first()
        slack = whole.slack or 0.0
        sums = pin(reports.where("term IS NOT NULL").groupBy("term").agg(
            F.sum("total").alias("low"), F.sum("df").alias("df"), (F.lit(slack) - F.sum("slack")).alias("more")
        ))
        # The sum over blocks may differ from the whole in its last digits.
        more = F.greatest(F.col("more"), F.lit(0.0)) + 1e-6 * (slack + 1)
        sure = sums.where((F.col("df") - surplus >= min_df) & (F.col("df") + more <= max_df))
        last = sure.orderBy(F.desc("low")).limit(wanted).agg(F.count("*").alias("n"), F.min("low").alias("low")).first()
        need = max(need, last.low if last.n == wanted else 0)
        if slack == 0 or slack < need:
            found = sums.where((F.col("low") + more >= need) & (F.col("df") + more >= min_df)).select("term")
            out = [r.term for r in found.limit(CANDIDATES + 1).collect()]
            unpin(reports, sums)
            return out if len(out) <= CANDIDATES else None
        unpin(reports, sums)
        # A term of ``need`` has at least its part of a total just below in some block.
        floor = (max(need - 0.5, 0.0), whole.tokens)
