"""Token counts against the tokenizer itself."""

import random
import sys

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from millrace.llm import tokens
from millrace.llm.plans import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def counts():
    path = tokens.vocabulary_path()
    return tokens.TokenCounts(path, tokens.whole_tokens(path))


def plain(tokenizer, text):
    return len(tokenizer.encode(text, add_special_tokens=False).ids)


def test_query_and_awkward_rows(spark, awkward, empty, tokenizer):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op13_token_counts"].run(spark, SF).collect()}
    want = {r.doc_id: (len(r.text.encode()), plain(tokenizer, r.text)) for r in docs.collect()}
    assert got == {i: (b, n, n > 1024) for i, (b, n) in want.items()}
    rows = tokens.count_tokens(awkward).collect()
    assert rows[0].asDict().keys() == {"doc_id", "n_bytes", "n_tokens", "over_limit"}
    want = [(r.doc_id, len((r.text or "").encode()), plain(tokenizer, r.text or "")) for r in awkward.collect()]
    assert sorted(map(repr, [tuple(r)[:3] for r in rows])) == sorted(map(repr, want))
    assert tokens.count_tokens(empty).count() == 0


TEXTS = [
    "", " ", "\n", "a  b", "  a", "a \n b\t\tc ", "it's we'll 'S don''t", "<|endoftext|>", "x <|endoftext|> y", "<|endoftext|><|endoftext|>",
    "<|endoftext|", " <|endoftext|>  \n z", "naïve Ünïcödé — 「日本語」 1²3 ٣٤", "\x1c\x1d\x85\xa0 x ​", "é ́", "🙂🙃 👩‍👩‍👧",
    "՘ ꟎ a₏", "a" * 3000, "1" * 999, "!?" * 500, " 　 " * 40, "�￾", "\0\x01",
]


def test_texts_and_random_mixtures(counts, tokenizer):
    rng = random.Random(5)
    pieces = [" ", "  ", "\n", "'s", "'", "the", "Th", "é", "ß", "7", "½", "!", "…", "<|endoftext|>", "\t", " ", "字", "🙂", "-", "͸"]
    texts = TEXTS + ["".join(rng.choices(pieces, k=rng.randint(1, 40))) for _ in range(3000)]
    assert [counts.count(t) for t in texts] == [plain(tokenizer, t) for t in texts]


def test_every_settled_character(counts, tokenizer):
    late = tokens.unsettled_characters()
    codes = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    settled = [c for c in codes if not late.search(c)]
    assert len(settled) > 280_000
    lines = ["".join(f"a{c}1{c}!{c} {c}{c}" for c in settled[i:i + 500]) for i in range(0, len(settled), 500)]
    cuts = tokenizer.pre_tokenizer.pre_tokenize_str
    for line in lines:
        assert [len(p) for p in counts.split(line)] == [b - a for _, (a, b) in cuts(line)]


def test_blanks_of_all_kinds(counts, tokenizer):
    rng = random.Random(6)
    kinds = ["ab", "x", " ", "  ", "\n", "\t", "\r", "\x0b", "\x1c", "\x85", "\xa0", "\u2028", "\u3000", "\u200b", "'s", "12", "!", "é"]
    for _ in range(5000):
        text = "".join(rng.choices(kinds, k=rng.randint(1, 30)))
        assert counts.count(text) == plain(tokenizer, text), repr(text)


def test_bounded_cache(tokenizer, monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_WORDS", 10)
    path = tokens.vocabulary_path()
    counts = tokens.TokenCounts(path, tokens.whole_tokens(path))
    text = " ".join("zqx" + "".join(random.Random(i).choices("jkvwyz", k=9)) for i in range(200))
    assert counts.count(text) == plain(tokenizer, text)
    assert len(counts) <= 11


def test_proof_leaves_out_what_is_not_whole(tokenizer):
    whole = tokens.whole_tokens(tokens.vocabulary_path())
    assert " the" in whole and "<|endoftext|>" not in whole
    assert all(plain(tokenizer, t) == 1 for t in whole) and len(whole) > 45_000


def test_other_kinds_of_files_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        tokens.checked(public_tokenizers.path("word_bpe_49k.json"))
