"""Token counts: words that are one token each are looked up, only the rest is merged."""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import columns

LIMIT = 1024
# Distinct words whose counts a task remembers.
CACHE_WORDS = 600_000

# A blank that follows white space, and all other blanks.
_LOOSE = re.compile(r"\s ")
_CUT = re.compile(r"(?<=\S) ")


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def whole_tokens(path: str) -> frozenset[str]:
    """Vocabulary strings that encode alone as one token, proven by encoding each of them.

    The merges of a byte-level BPE work inside a pre-token and see nothing around it, and no
    token spans two pre-tokens. So a string that alone gives its own single id is one
    pre-token, and gives that id wherever a text has it as a pre-token. Ids of partial
    characters and strings that other merges break up are left out.
    """
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    ids = range(tokenizer.get_vocab_size())
    texts = [tokenizer.decode([i], skip_special_tokens=False) for i in ids]
    added = {token.content for token in tokenizer.get_added_tokens_decoder().values()}
    alone = tokenizer.encode_batch(texts, add_special_tokens=False)
    return frozenset(t for i, t, e in zip(ids, texts, alone) if t not in added and e.ids == [i])


def unsettled_characters() -> re.Pattern:
    """Characters that Python's Unicode tables leave unassigned.

    Libraries of different Unicode versions may sort them as letters or not, so a word that
    holds one is left to the tokenizer itself.
    """
    ranges, start = [], None
    for code in range(sys.maxunicode + 2):
        late = code <= sys.maxunicode and unicodedata.category(chr(code)) == "Cn"
        if late and start is None:
            start = code
        elif not late and start is not None:
            ranges.append(f"\\U{start:08x}-\\U{code - 1:08x}")
            start = None
    return re.compile(f"[{''.join(ranges)}]")


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: visible Latin-1 characters for themselves, others from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class TokenCounts(dict):
    """Number of tokens of a blank and the word behind it, remembered per word.

    A new word is split into pre-tokens: proven ones count one, the rest is merged.
    """

    def __init__(self, path: str, whole: frozenset[str]):
        import public_tokenizers
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        self.letters = byte_letters()
        self.whole = whole
        self.split = regex.compile(public_tokenizers.PATTERN).findall
        self.unsettled = unsettled_characters()
        self.added = sorted(
            (token.content for token in self.tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True
        )
        self.cut_added = re.compile("|".join(map(re.escape, self.added))).split if self.added else None

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        n = self.pre_tokens(f" {word}")
        if len(word) <= 64:
            self[word] = n
        return n

    def merged(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def pre_tokens(self, text: str) -> int:
        if not text.isascii() and self.unsettled.search(text):
            return self.merged(text)
        n = 0
        for part in self.split(text):
            n += 1 if part in self.whole else len(self.merge(part.encode().decode("latin-1").translate(self.letters)))
        return n

    def _ordinary(self, text: str) -> int:
        # A pre-token ends before a blank that follows a visible character, whatever comes then.
        first, *rest = _CUT.split(text) if _LOOSE.search(text) else text.split(" ")
        return self.pre_tokens(first) + sum(map(self.__getitem__, rest))

    def count(self, text: str) -> int:
        """Tokens of a whole text; an added token inside it is one token, as the tokenizer's default has it."""
        if not any(map(text.__contains__, self.added)):
            return self._ordinary(text)
        parts = self.cut_added(text)
        return len(parts) - 1 + sum(map(self._ordinary, parts))


def checked(path: str) -> str:
    """The path, if its file cuts and merges as ``TokenCounts`` does."""
    import json

    with open(path, encoding="utf-8") as lines:
        held = json.load(lines)
    cut, model = held.get("pre_tokenizer") or {}, held.get("model") or {}
    plain = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
    strict = any(token["single_word"] or token["lstrip"] or token["rstrip"] for token in held.get("added_tokens", []))
    if not plain or strict or held.get("normalizer") or model.get("type") != "BPE" or model.get("dropout"):
        raise ValueError(f"{path} is not a plain byte-level BPE vocabulary")
    return path


def count_tokens(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, limit: int = LIMIT,
) -> DataFrame:
    """Bytes and tokens of every whole text, and whether the tokens exceed ``limit``.

    Counts are those of ``tokenizers`` with the given byte-level BPE file and no special tokens
    added. A NULL text counts as empty: no bytes, no tokens. Repeated rows and rows without
    id give a row each, an empty table gives none; further columns are ignored. Nothing is
    shuffled. Returns doc_id, n_bytes, n_tokens, over_limit.
    """
    path = checked(vocabulary or vocabulary_path())
    whole = whole_tokens(path)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counts = None
        for texts in batches:
            counts = counts or TokenCounts(path, whole)
            yield pd.Series([counts.count(t) for t in texts.tolist()], dtype="int64")

    rows = columns(docs, doc_id=id_col, text=text_col).withColumn("text", F.coalesce("text", F.lit("")))
    return rows.select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"),
        F.pandas_udf(run, "long")("text").alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > limit)
