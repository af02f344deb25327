"""Stupid-backoff scores from n-gram count tables that are partitioned by hash."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import columns
from millrace.session import new_path

ORDER = 3
# An n-gram of two or more words is used from so many occurrences in the corpus.
MIN_COUNT = 2
BACKOFF = 0.4
# Text bytes whose n-grams are exploded together, and about so many n-grams per hash bucket.
BLOCK_BYTES = 5_000_000
BUCKET_GRAMS = 1_000_000
# Distinct words whose hashes a worker remembers.
CACHE_WORDS = 400_000
KEY_BITS = 56

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = out = xxhash.xxh64_intdigest(word)
        return out


def packed(values: np.ndarray) -> bytes:
    """Whole numbers as compressed byte planes."""
    return zstandard.compress(values.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), dtype=np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def gram_keys(words: np.ndarray, starts: np.ndarray, order: int) -> list[np.ndarray]:
    """For each length the key of the n-gram ending at every word; 0 where the document is too short."""
    inside = np.arange(len(words)) - np.repeat(starts, np.diff(np.r_[starts, len(words)]))
    out, chain = [], words
    for n in range(1, order + 1):
        if n > 1:
            earlier = np.zeros_like(chain)
            earlier[1:] = chain[:-1]
            chain = earlier * _MULTIPLIER + words
        x = chain ^ np.uint64(n * 0x632BE59BD9B4E019 % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        key = (x ^ (x >> np.uint64(31))) >> np.uint64(64 - KEY_BITS)
        out.append(np.where(inside >= n - 1, np.maximum(key, np.uint64(1)), np.uint64(0)))
    return out


def _starts(lengths: np.ndarray) -> np.ndarray:
    return np.cumsum(lengths) - lengths


def _grams(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    every = np.concatenate(keys)
    return np.unique(every[every > 0], return_counts=True)


def _tokens(row) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of a block, and the words of each of its documents that has any."""
    lengths = unpacked(row["lengths"]).astype(np.int64)
    return unpacked(row["words"])[unpacked(row["tokens"]).astype(np.int64)], lengths


def token_blocks(docs: DataFrame) -> DataFrame:
    """Documents as blocks of word numbers, a few megabytes of text each."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, block = _Hashes(), TaskContext.get().partitionId() << 32
        ids, lengths, hashes, held = [], [], [], 0

        def done() -> pd.DataFrame:
            words, tokens, counts = np.unique(
                np.array(hashes, dtype=np.uint64), return_inverse=True, return_counts=True
            )
            frequent = np.argsort(-counts, kind="stable")  # small numbers for frequent words compress best
            number = np.empty_like(frequent)
            number[frequent] = np.arange(len(frequent))
            return pd.DataFrame({
                "block": [block], "doc_ids": [ids], "lengths": [packed(np.array(lengths))],
                "words": [packed(words[frequent])], "tokens": [packed(number[tokens])], "n_tokens": [len(hashes)],
            })

        for batch in batches:
            for doc, text in zip(batch["doc_id"].tolist(), batch["text"].tolist()):
                words = text.encode().lower().split() if text else []
                ids.append(None if doc is None or doc != doc else int(doc))
                lengths.append(len(words))
                hashes += [known[w] for w in words]
                held += len(text or "") + 8
                if held >= BLOCK_BYTES:
                    yield done()
                    block, held = block + 1, 0
                    ids, lengths, hashes = [], [], []
        if ids:
            yield done()

    return docs.mapInPandas(
        run, "block long, doc_ids array<long>, lengths binary, words binary, tokens binary, n_tokens long"
    )


def kept_by_block(blocks: DataFrame) -> DataFrame:
    """Write the blocks as a table bucketed by block, so that they never move again."""
    spark = blocks.sparkSession
    name = f"token_blocks_{uuid.uuid4().hex}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks.write.bucketBy(parts, "block").option("path", new_path(spark, "blocks")).saveAsTable(name)
    kept = spark.table(name)
    kept.schema  # resolved; the name in the catalog is no longer needed, the files stay
    spark.sql(f"DROP TABLE {name}")
    return kept


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> np.uint64(KEY_BITS - 32)) * np.uint64(buckets)) >> np.uint64(32)


def exploded(blocks: DataFrame, order: int, buckets: int) -> DataFrame:
    """Distinct n-grams of each block with their counts, one row per block and hash bucket."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, row in batch.iterrows():
                words, lengths = _tokens(row)
                keys, counts = _grams(gram_keys(words, _starts(lengths), order))
                if not len(keys):
                    continue
                bucket = _bucket(keys, buckets)
                cut = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
                ends = np.r_[cut[1:], len(keys)]
                yield pd.DataFrame({
                    "block": row["block"], "bucket": bucket[cut].astype(np.int64),
                    "keys": [packed(np.diff(keys[a:b], prepend=np.uint64(0))) for a, b in zip(cut, ends)],
                    "counts": [packed(counts[a:b]) for a, b in zip(cut, ends)],
                })

    return blocks.select("block", "lengths", "words", "tokens").mapInPandas(
        run, "block long, bucket long, keys binary, counts binary"
    )


def _sum_bucket(frame: pd.DataFrame) -> pd.DataFrame:
    """Corpus counts of a bucket's n-grams, handed back to the blocks that hold them."""
    keys = [np.cumsum(unpacked(k), dtype=np.uint64) for k in frame["keys"]]
    _, where = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(where, weights=np.concatenate([unpacked(c) for c in frame["counts"]]))
    ends = np.cumsum([len(k) for k in keys])
    answers = [packed(total[where[b - len(k):b]].astype(np.uint64)) for k, b in zip(keys, ends)]
    return pd.DataFrame({"block": frame["block"], "bucket": frame["bucket"], "totals": answers})


def backoff_scores(counts: list[np.ndarray], total: int, min_count: int = MIN_COUNT, backoff: float = BACKOFF):
    """Natural log of the stupid-backoff score of every word, and the order it was scored at.

    ``counts[n - 1]`` are the corpus counts of the n-grams ending at each word, 0 where the
    document is too short for one.
    """
    score = np.log(counts[0] / total)
    used = np.ones(len(score), dtype=np.int64)
    for n in range(2, len(counts) + 1):
        there = counts[n - 1] > 0
        context = np.r_[0, counts[n - 2][:-1]]
        good = counts[n - 1] >= min_count
        higher = np.log(np.where(good, counts[n - 1], 1)) - np.log(np.where(good, context, 1))
        score = np.where(good, higher, np.where(there, score + math.log(backoff), score))
        used = np.where(good, n, used)
    return score, used


def score_documents(
    docs: DataFrame, order: int = ORDER, min_count: int = MIN_COUNT, backoff: float = BACKOFF,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Stupid-backoff score of every document under n-gram counts of the whole corpus.

    Words stand between ASCII blanks after lower-casing A-Z; n-grams stay within a document.
    A word scores c(n-gram) / c(context) at the longest order whose n-gram occurs at
    least ``min_count`` times, times ``backoff`` for each order given up; a single word
    scores c(word) / c(all). The n-grams of each block of documents are exploded to hash
    buckets, counts are summed there over all blocks, and go back to the blocks, where they
    are added up per document. Frequent n-grams are summed within a block before they
    move. Keys have 56 bits. A document without words (NULL, empty) has n_words 0,
    log_score 0 and no mean; repeated rows are counted and scored each; further columns
    are ignored; an empty table gives no rows. Returns doc_id, n_words, log_score, mean_log,
    n_full (words scored at the highest order).
    """
    rows = columns(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    blocks = kept_by_block(token_blocks(rows))
    total = int(blocks.agg(F.sum("n_tokens")).first()[0] or 0)
    buckets = max(8, math.ceil(total * order / 2 / BUCKET_GRAMS))
    totals = exploded(blocks, order, buckets).groupBy("bucket").applyInPandas(
        _sum_bucket, "block long, bucket long, totals binary"
    )

    def score(frame: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, row in frame.iterrows():
            words, lengths = _tokens(row)
            keys = gram_keys(words, _starts(lengths), order)
            known, _ = _grams(keys)
            parts = answers.sort_values("bucket")["totals"]
            counts = np.concatenate([unpacked(p) for p in parts] or [np.zeros(0, np.uint64)]).astype(np.float64)
            every = [
                np.where(k > 0, np.r_[counts, 0.0][np.searchsorted(known, k)], 0.0) for k in keys
            ]
            logs, used = backoff_scores(every, total, min_count, backoff) if len(words) else (np.zeros(0),) * 2
            starts = _starts(lengths)
            sums = np.r_[logs, 0.0]
            has = lengths > 0
            value, full = np.zeros(len(lengths)), np.zeros(len(lengths), dtype=np.int64)
            if has.any():
                value[has] = np.add.reduceat(sums[:-1], starts[has])
                full[has] = np.add.reduceat((used == order).astype(np.int64), starts[has])
            out.append(pd.DataFrame({
                "doc_id": pd.array(list(row["doc_ids"]), dtype="Int64"), "n_words": lengths, "log_score": value,
                "mean_log": np.where(has, value / np.maximum(lengths, 1), np.nan), "n_full": full,
            }))
        return pd.concat(out) if out else pd.DataFrame(columns=["doc_id", "n_words", "log_score", "mean_log", "n_full"])

    held = blocks.select("block", "doc_ids", "lengths", "words", "tokens")
    scored = held.groupBy("block").cogroup(totals.groupBy("block")).applyInPandas(
        score, "doc_id long, n_words long, log_score double, mean_log double, n_full long"
    )
    return scored.withColumn("mean_log", F.nanvl("mean_log", F.lit(None)))
