"""License scans: exact set-similarity join of text blocks with license templates."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import columns

# Notices by which works declare their license.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "bsd-3-clause": "Redistribution and use in source and binary forms, with or without modification, are permitted "
                    "provided that the following conditions are met",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "gpl-3.0": "Licensed under the GNU General Public License, version 3",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
           "is hereby granted",
    "mit": "Released under the MIT License",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "public-domain": "This is free and unencumbered software released into the public domain",
}
# Usual headers of files, besides the sections of the texts in license_texts.
HEADERS = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at"),
    *[(label, f"This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
              f"General Public License as published by the Free Software Foundation, either version {version} of the "
              "License, or (at your option) any later version")
      for label, version in (("gpl-2.0", 2), ("gpl-3.0", 3))],
    ("gpl-2.0", "Licensed under the GNU General Public License, version 2"),
]
# Short names of licenses; of up to SHORT_WORDS words, they must stand as written to label a text.
SHORT = [
    ("apache-2.0", "Apache 2.0"), ("bsd-3-clause", "BSD 3-Clause License"), ("gpl-3.0", "GNU GPL v3"), ("mit", "MIT License"),
    ("mit", "SPDX-License-Identifier: MIT"),
]
SHORT_WORDS = 4
# What a notice of up to NAMED_WORDS distinct words must spell out besides the threshold, for
# each label one phrase of every group.
NAMED_WORDS = 60
NAMES = {
    "apache-2.0": [["apache license"], ["version 2"]],
    "cc-by-4.0": [["attribution 4 0"]],
    "cc-by-nc-4.0": [["by nc 4"]],
    "gpl-2.0": [["gnu general public license"], ["version 2"]],
    "gpl-3.0": [["gnu general public license"], ["version 3"]],
    "isc": [["without fee"]],
    "mit": [["mit license"]],
    "mpl-2.0": [["mozilla public license"], ["v 2", "version 2"]],
}
# Distinct words from which a paragraph of a license text tells that license.
SECTION_WORDS = 20
# Phrases searched word by word, and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Templates are handed to every task, so their size is bounded.
MAX_TEMPLATE_WORDS = 1_000_000

# ASCII letters and digits stay, lower-cased; every other ASCII byte separates words.
_TABLE = bytes(ord(chr(b).lower()) if b >= 128 or chr(b).isalnum() and b < 128 else 32 for b in range(128)) + bytes(
    range(128, 256)
)

FOUND = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, matches array<struct<label: string, block: int, lines: int, containment: double, tells: boolean>>"
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def phrase_starts(words: list[bytes], phrases: list[tuple[list[bytes], str]]) -> list[tuple[int, str]]:
    """Start and label of every place where a phrase's words stand consecutively."""
    line = b" " + b" ".join(words) + b" "
    out = []
    for phrase, label in phrases:
        needle = b" " + b" ".join(phrase) + b" "
        at, seen, words_before = line.find(needle), 0, 0
        while at >= 0:
            words_before += line.count(b" ", seen, at)
            seen = at
            out.append((words_before, label))
            at = line.find(needle, at + 1)
    return out


@lru_cache
def sections(threshold: float) -> list[tuple[str, str]]:
    """Label and text of every long enough paragraph of the license texts that no other text nearly holds in one place."""
    texts = {path.stem: path.read_text(encoding="utf-8") for path in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))}
    words = {label: words_of(text.encode()) for label, text in texts.items()}

    def held(part: list[bytes], whole: list[bytes]) -> bool:
        own, size, step = set(part), len(part) * 5 // 4, max(1, len(part) // 8)
        need = (threshold - 0.05) * len(own)
        return len(own.intersection(whole)) >= need and any(
            len(own.intersection(whole[i:i + size])) >= need for i in range(0, len(whole), step)
        )

    out = []
    for label, text in texts.items():
        for part in re.split(r"\n\s*\n", text):
            own = words_of(part.encode())
            if len(set(own)) >= SECTION_WORDS and not any(held(own, w) for other, w in words.items() if other != label):
                out.append((label, part))
    return out


class TemplateIndex:
    """Templates in the global token order, with the tokens of each prefix listed."""

    def __init__(
        self, templates: list[tuple[str, str]], counts: dict[bytes, int], threshold: float,
        names: dict[str, list[list[str]]] | None = None,
    ):
        self.threshold = threshold
        self.templates = []
        self.lengths = []
        self.names_known = names is not None
        self.names = []
        self.rank = {t: i for i, t in enumerate(sorted(counts, key=lambda t: (counts[t], t)))}
        self.prefix: dict[int, list[tuple[int, int]]] = {}
        for label, text in templates:
            words = words_of(text.encode())
            tokens = sorted({self.rank[w] for w in words})
            if not tokens:
                continue
            need = max(1, math.ceil(threshold * len(tokens) - 1e-9))
            for i in range(len(tokens) - need + 1):
                self.prefix.setdefault(tokens[i], []).append((len(self.templates), i))
            self.templates.append((label, tokens, need))
            self.lengths.append(len(words))
            # Only names that the template spells out itself are asked of a block.
            line = b" " + b" ".join(words) + b" "
            groups = [[b" " + p.encode() + b" " for p in group] for group in (names or {}).get(label, ())]
            own = len(tokens) <= NAMED_WORDS and all(any(p in line for p in group) for group in groups)
            short = names is not None and len(words) <= SHORT_WORDS
            self.names.append([[line]] if short else groups if own else [])
        self.seeds = {w for w, r in self.rank.items() if r in self.prefix}

    def shared(self, tokens: list[int], words: list[bytes]) -> int:
        return len({self.rank[w] for w in words if w in self.rank}.intersection(tokens))

    def share(self, t: int, words: list[bytes]) -> float:
        """Share of a template's tokens that the block holds, 0 if below the threshold or if it does not name the license."""
        _, tokens, need = self.templates[t]
        shared = self.shared(tokens, words)
        # A long line holds the words of many a section by chance; they must stand close together.
        size = self.lengths[t] * 5 // 4
        if shared >= need and len(tokens) > SECTION_WORDS and self.names_known and len(words) > size:
            step = max(1, self.lengths[t] // 8)
            shared = max(self.shared(tokens, words[i:i + size]) for i in range(0, len(words) - size + step, step))
        if shared < need:
            return 0.0
        if self.names[t]:
            line = b" " + b" ".join(words) + b" "
            if not all(any(p in line for p in group) for group in self.names[t]):
                return 0.0
        return shared / len(tokens)

    def candidates(self, words: list[bytes]) -> list[int]:
        """Templates, by number, of which the block holds the threshold share of tokens."""
        own = sorted({self.rank[w] for w in words if w in self.rank})
        have, tried, out = set(own), set(), []
        for j, token in enumerate(own):
            for t, i in self.prefix.get(token, ()):
                if t in tried:
                    continue
                tried.add(t)  # the first token they share in the global order
                _, tokens, need = self.templates[t]
                if len(own) < need or 1 + min(len(tokens) - i - 1, len(own) - j - 1) < need:
                    continue
                if len(have.intersection(tokens)) >= need:
                    out.append(t)
        return out

    def search(self, lines: list[list[bytes]]) -> list[tuple[str, int, int, float, bool]]:
        """Label, first line, number of lines, share of every match in a text's lines, and whether it tells the license.

        Blocks are lines and paragraphs (runs of several lines with words): all that hold the threshold
        share of a template's words are there. Those that pass the conditions of ``share`` too tell the
        license, and so do windows of a paragraph's lines that grow to the template's length and do,
        where no line in them does. The best of a label and block is kept.
        """
        best: dict[tuple[str, int, int], tuple[float, bool]] = {}

        def put(label: str, block: int, n: int, share: float, tells: bool) -> None:
            have = best.get((label, block, n), (0.0, False))
            best[label, block, n] = (max(share, have[0]), tells or have[1])

        at = 0
        while at < len(lines):
            end = at + 1
            while lines[at] and end < len(lines) and lines[end]:
                end += 1
            part = lines[at:end]
            whole = [w for line in part for w in line]
            if not self.seeds.isdisjoint(whole):
                alone = set()
                for i, line in enumerate(part):
                    if not self.seeds.isdisjoint(line):
                        for t in self.candidates(line):
                            tells = self.share(t, line) > 0
                            put(self.templates[t][0], at + i, 1, self.containment(t, line), tells)
                            if tells:
                                alone.add((t, i))
                for t in self.candidates(whole) if len(part) > 1 else ():
                    put(self.templates[t][0], at, len(part), self.containment(t, whole), False)
                    for i, n, share in self.windows(t, part, {j for k, j in alone if k == t}):
                        put(self.templates[t][0], at + i, n, share, True)
            at = end
        return [(*key, *found) for key, found in sorted(best.items(), key=lambda x: (x[0][1], x[0]))]

    def containment(self, t: int, words: list[bytes]) -> float:
        tokens = self.templates[t][1]
        return self.shared(tokens, words) / len(tokens)

    def windows(self, t: int, part: list[list[bytes]], alone: set[int]) -> Iterator[tuple[int, int, float]]:
        """First line, number of lines and share of the windows of lines that match, none overlapping the one before."""
        ends = np.cumsum([len(line) for line in part])
        tokens = self.templates[t][1]
        useful = [any(self.rank.get(w) in tokens for w in line) for line in part]
        i = 0
        while i < len(part):
            # The first line may begin with other words, so the template may end this far behind it.
            j = int(np.searchsorted(ends, ends[i] + self.lengths[t])) + 1
            rows = part[i:j]
            share = self.share(t, [w for line in rows for w in line]) if useful[i] and alone.isdisjoint(range(i, j)) else 0.0
            if not share:
                i += 1
                continue
            while i + 1 < len(part):  # later lines may begin closer to the template
                k = int(np.searchsorted(ends, ends[i + 1] + self.lengths[t])) + 1
                next_share = self.share(t, [w for line in part[i + 1:k] for w in line]) if alone.isdisjoint(range(i + 1, k)) else 0.0
                if next_share < share:
                    break
                i, j, share = i + 1, k, next_share
            yield i, min(j, len(part)) - i, share
            i = j


def token_counts(docs: DataFrame, tokens: set[bytes]) -> dict[bytes, int]:
    """Occurrences of the templates' tokens in the whole corpus; as many rows as there are tokens."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()
        for batch in batches:
            for text in batch["text"].tolist():
                words = words_of((text or "").encode())
                if not tokens.isdisjoint(words):
                    total.update(filter(tokens.__contains__, words))
        if total:
            yield pd.DataFrame({"token": list(total), "n": np.array(list(total.values()), dtype=np.int64)})

    counted = docs.select("text").mapInPandas(run, "token binary, n long")
    rows = counted.groupBy("token").agg(F.sum("n").alias("n")).collect()
    return dict.fromkeys(tokens, 0) | {bytes(r.token): r.n for r in rows}


def scan_licenses(
    docs: DataFrame, templates: dict[str, str] | None = None, phrases: dict[str, str] | None = None,
    threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Find license notices and the sections of license texts in every document.

    A text block is a line, or a paragraph: a run of several consecutive lines with words. ``matches`` holds every block
    with at least ``threshold`` of a template's distinct words, and its containment; no match is lost. Not
    every one of them tells a license: a long block holds the words of many a notice by chance. ``tells``
    marks those that do, and gives ``labels`` and ``score``: a block, or a window of lines as long as
    the template, that also holds the words that name the license (NAMES; names of up to
    SHORT_WORDS words as written), and for templates of more than SECTION_WORDS distinct words
    holds them within a quarter more words than they have. Without ``templates`` those
    are TEMPLATES, HEADERS, SHORT and the paragraphs of the texts in license_texts that tell
    one license from the others; given ones are
    compared by the threshold alone. Words are runs of letters and digits after lower-casing A-Z. Template
    words are ordered by their frequency in the corpus, rarest first; a block is compared
    only if it holds a word of a template's prefix (prefix filter), has enough words
    (length filter) and can still reach the threshold after the first shared word
    (positional filter). Besides, the places of fixed phrases are
    counted; all of them count, overlapping ones too. The score is the highest containment
    that tells, 1 for a phrase and 0 for nothing. NULL text counts as empty; repeated rows
    give a row each; further columns are ignored; an empty table gives no rows.
    Returns FOUND.
    """
    names = NAMES if templates is None else None
    held = [*TEMPLATES.items(), *HEADERS, *SHORT, *sections(threshold)] if templates is None else list(templates.items())
    phrase_words = [(words_of(p.encode()), label) for p, label in (PHRASES if phrases is None else phrases).items()]
    tokens = {w for _, text in held for w in words_of(text.encode())}
    if len(tokens) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"templates may hold {MAX_TEMPLATE_WORDS} distinct words; scan them in parts")
    rows = columns(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    index = TemplateIndex(held, token_counts(rows, tokens), threshold, names)

    def one(text: str) -> tuple:
        raw = text.encode()
        words = words_of(raw)
        places = phrase_starts(words, phrase_words)
        matches = []
        if not index.seeds.isdisjoint(words):
            lines = [words_of(line) for line in raw.split(b"\n")]
            matches = index.search(lines)
        base = {label for _, label in places}
        starts = [at for at, _ in places]
        return (
            len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | {m[0] for m in matches if m[4]})),
            max([m[3] for m in matches if m[4]] + [1.0] * bool(base), default=0.0),
            [dict(zip(("label", "block", "lines", "containment", "tells"), m)) for m in matches],
        )

    fields = [c.split()[0] for c in FOUND.split(", matches")[0].split(", ")[1:]] + ["matches"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = pd.DataFrame([one(t or "") for t in batch["text"].tolist()], columns=fields)
            for name in ("first_word", "last_word"):
                found[name] = found[name].astype("Int64")
            found.insert(0, "doc_id", batch["doc_id"].astype("Int64").to_numpy(object, na_value=None))
            found["doc_id"] = found["doc_id"].astype("Int64")
            yield found

    return rows.mapInPandas(run, FOUND)
