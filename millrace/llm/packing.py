"""Packing of tokenised documents into sequences of balanced attention cost."""

from __future__ import annotations

import base64
import heapq
import json
import re
import sys
import zlib
from array import array
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import columns

CAPACITY = 2048
END_ID = 1
# Tokens a task holds before it packs them; the last sequence of such a window may stay short.
WINDOW_TOKENS = 8_000_000
# Distinct words whose ids a worker remembers.
CACHE_WORDS = 600_000

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "cost double"
)


def vocabulary_path() -> str:
    """Ranks of the byte-level BPE vocabulary; the same ids as ``byte_bpe_50k.json``."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class Encoder(dict):
    """Ids of a text as little-endian bytes, word by word.

    A space between two other visible characters always begins a token, so the parts
    around it can be encoded apart. What follows such a space is remembered. The added
    tokens of the ``.json`` file beside the ranks are cut out of the text first, as ``tokenizers`` does.
    """

    _CUT = re.compile(r"(?<=\S) (?=\S)")

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
        self.plain = tiktoken.Encoding(
            "bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary
        self.added = {}
        described = Path(path).with_suffix(".json")
        if described.exists():
            held = json.loads(described.read_text(encoding="utf-8"))["added_tokens"]
            self.added = {token["content"]: token["id"] for token in held}
        longest = sorted(map(re.escape, self.added), key=len, reverse=True)
        self.cut_added = re.compile(f"({'|'.join(longest)})").split if longest else None

    def ids(self, text: str) -> bytes:
        out = array("I", self.plain(text))
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def __missing__(self, part: str) -> bytes:
        if len(self) >= CACHE_WORDS:
            self.clear()
        out = self.ids(f" {part}")
        if len(part) <= 64:
            self[part] = out
        return out

    def encode(self, text: str) -> bytes:
        if not any(map(text.__contains__, self.added)):
            return self.encode_words(text)
        # Ordinary text and added tokens take turns.
        parts = self.cut_added(text)
        parts[1::2] = [self.added[token].to_bytes(4, "little") for token in parts[1::2]]
        parts[::2] = [self.encode_words(part) if part else b"" for part in parts[::2]]
        return b"".join(parts)

    def encode_words(self, text: str) -> bytes:
        # As many words as single blanks and line ends allow: every blank stands between two visible characters.
        tidy = len(text.split()) == text.count(" ") + text.count("\n") + 1
        first, *rest = text.split(" ") if tidy else self._CUT.split(text)
        return self.ids(first) + b"".join(map(self.__getitem__, rest))


def attention_cost(length, capacity: int = CAPACITY):
    """Work of a piece: linear layers plus attention, which grows with the square."""
    return length + length * length / capacity


def pack_lengths(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Assign documents to sequences; returns document, start, length and sequence per piece.

    Full sequences are cut off first. The rests go, longest first, each to the sequence of
    lowest cost that has room. A rest that fits nowhere is cut over the sequences with the
    most room. The number of sequences is the least possible, so only one stays short.
    """
    whole = lengths // capacity
    doc = np.repeat(np.arange(len(lengths)), whole)
    start = (np.arange(len(doc)) - np.repeat(np.cumsum(whole) - whole, whole)) * capacity
    pieces = [(doc, start, np.full(len(doc), capacity), np.arange(len(doc)))]
    rest = lengths - whole * capacity
    order = np.argsort(-rest, kind="stable")
    order = order[rest[order] > 0]
    n = -(-int(rest.sum()) // capacity)
    room = [capacity] * n
    cost = [0.0] * n
    if n:
        room[-1] = int(rest.sum()) - capacity * (n - 1)
    cheapest = [(0.0, s) for s in range(n)]
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]  # sequences without room for the present length
    placed: list[tuple[int, int, int, int]] = []

    def put(d: int, at: int, size: int, s: int) -> None:
        placed.append((d, at, size, s))
        room[s] -= size
        cost[s] += attention_cost(size, capacity)

    limit = capacity
    for d in order.tolist():
        size = int(rest[d])
        while limit > size:  # shorter rests fit where longer ones did not
            limit -= 1
            for s in waiting[limit]:
                if room[s] == limit:
                    heapq.heappush(cheapest, (cost[s], s))
            waiting[limit] = []
        at = int(whole[d]) * capacity
        while cheapest and room[cheapest[0][1]] < size:
            s = heapq.heappop(cheapest)[1]
            waiting[room[s]].append(s)
        if cheapest:
            s = heapq.heappop(cheapest)[1]
            put(d, at, size, s)
            if room[s]:
                heapq.heappush(cheapest, (cost[s], s))
            continue
        level = limit
        while size:  # every open sequence has less room than the rest is long
            while not waiting[level] or room[waiting[level][-1]] != level:
                if waiting[level]:
                    waiting[level].pop()
                else:
                    level -= 1
            s = waiting[level].pop()
            take = min(size, room[s])
            put(d, at, take, s)
            at, size = at + take, size - take
            if room[s]:
                waiting[room[s]].append(s)
    if placed:
        d, at, size, s = map(np.array, zip(*placed))
        pieces.append((d, at, size, s + len(doc)))
    return tuple(np.concatenate(x) for x in zip(*pieces))


def _pack(ids: list[bytes], docs: list, first: int, capacity: int) -> tuple[pd.DataFrame, int]:
    lengths = np.array([len(x) // 4 for x in ids], dtype=np.int64)
    doc, start, length, seq = pack_lengths(lengths, capacity)
    order = np.lexsort((start, doc, seq))
    doc, start, length, seq = doc[order], start[order], length[order], seq[order]
    total = np.cumsum(length) - length
    fresh = np.r_[True, seq[1:] != seq[:-1]] if len(seq) else np.zeros(0, bool)
    offset = total - np.repeat(total[fresh], np.diff(np.r_[np.flatnonzero(fresh), len(seq)]))
    crc = [zlib.crc32(ids[d][4 * a:4 * (a + n)]) for d, a, n in zip(doc.tolist(), start.tolist(), length.tolist())]
    out = pd.DataFrame({
        "doc_id": pd.array([docs[d] for d in doc.tolist()], dtype="Int64"), "start": start, "length": length,
        "ids_crc32": np.array(crc, dtype=np.int64), "doc_tokens": lengths[doc], "sequence_id": seq + first,
        "offset": offset, "cost": attention_cost(length, capacity),
    })
    return out, first + int(fresh.sum())


def pack_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None,
    capacity: int = CAPACITY, end_id: int = END_ID, window_tokens: int = WINDOW_TOKENS,
) -> DataFrame:
    """Cut documents into pieces and place them in sequences of at most ``capacity`` tokens.

    Each task packs what it reads, a window of tokens at a time: nothing is shuffled,
    memory is bounded, and at most one sequence per window is not full. Every document
    ends with ``end_id``, so a NULL or empty text is one piece of that id alone. Repeated
    rows are packed each on its own; an empty table gives no rows. Further columns are
    ignored. Returns PIECES, where cost is the estimate the balance rests on.
    """
    path = vocabulary or vocabulary_path()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = None
        end = np.array([end_id], dtype="<u4").tobytes()
        first = TaskContext.get().partitionId() << 36
        ids: list[bytes] = []
        names: list = []
        held = 0
        for batch in batches:
            if encoder is None:
                encoder = Encoder(path)
            for name, text in zip(batch["doc_id"].tolist(), batch["text"].tolist()):
                ids.append(encoder.encode(text or "") + end)
                names.append(None if name is None or name != name else name)
                held += len(ids[-1]) // 4
                if held >= window_tokens:
                    out, first = _pack(ids, names, first, capacity)
                    yield out
                    ids, names, held = [], [], 0
        if ids:
            yield _pack(ids, names, first, capacity)[0]

    rows = columns(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.mapInPandas(run, PIECES)
