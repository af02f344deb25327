"""Private data, licenses, language, language-model scores, leaked items, web pages."""

import hashlib
import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.llm import decontaminate, html, langid, licenses, lm, pii
from millrace.llm.plans import QUERIES
from tests.llm.conftest import PROSE

SF = "/root/testdata/sf0.001"


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        d = d * 2 if i % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def digits(value):
    return re.sub("[^0-9]", "", value)


BASE = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(p) <= 255 for p in v.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda v: 16 <= len(digits(v)) <= 19 and luhn(digits(v))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 8 <= len(digits(v)) <= 15),
)


def plain_spans(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p, ok in BASE for m in re.finditer(p, text or "") if ok(m.group())]


PRIVATE = [
    "a@b.c_d@e.f x@y a.b@c.d.e", "1.2.3.4.5.6.7.8 256.1.1.1 0255.0.0.1", "+1 (555) 123-4567.. +33+44 1234 5678",
    "4111 1111 1111 1111 4111-1111-1111-1111 411111111111111 é 4111111111111111222233334444", "é" * 50 + "a@b.co, ",
    "11111111111111111111111111111 @ @@ a@@b.c", "x" * 5000 + "@" + "y." * 3, "", None, "1-2-3-4", "Call +49 30 1234567",
    "mail a@b.cd\nmail a@b.cd", "4444 " * 4000,
]


def test_private_spans(spark):
    docs = spark.createDataFrame(list(enumerate(PRIVATE)) + [(None, "x@y.zz"), (0, PRIVATE[0])], "doc_id long, text string")
    got = sorted((str(r.doc_id), [f"{s.kind}:{s.start}:{s.end}" for s in r.found]) for r in pii.scan_private_data(docs).collect())
    assert got == sorted((str(r.doc_id), plain_spans(r.text)) for r in docs.collect())


def test_private_checksums_and_context(spark):
    docs = spark.createDataFrame(
        [(1, "IBAN DE89370400440532013000"), (2, "DE89370400440532013001"), (3, "code GB82WEST12345698765432")],
        "doc_id long, text string",
    )
    got = {r.doc_id: [(s.kind, round(s.score, 2)) for s in r.found] for r in pii.scan_private_data(docs).collect()}
    assert got == {1: [("iban", 0.9)], 2: [], 3: [("iban", 0.7)]}


def test_private_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op3_private_data"].run(spark, SF).collect():
        want = plain_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s.startswith(k) for s in want) for k in pii.BASE)


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_license(text):
    words = plain_words(text)
    places = [
        (i, label) for phrase, label in licenses.PHRASES.items() for i in range(len(words))
        if words[i:i + len(phrase.split())] == phrase.split()
    ]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({label for _, label in places}))


def plain_matches(text):
    """Every line and every run of several lines with words against every template."""
    lines = (text or "").split("\n")
    blocks, at = [(i, 1) for i in range(len(lines))], 0
    while at < len(lines):
        end = at
        while end < len(lines) and plain_words(lines[end]):
            end += 1
        if end - at > 1:
            blocks.append((at, end - at))
        at = max(end, at + 1)
    found = {}
    for at, n in blocks:
        have = set(plain_words("\n".join(lines[at:at + n])))
        for label, template in [*licenses.TEMPLATES.items(), *licenses.HEADERS, *licenses.SHORT, *licenses.sections(0.8)]:
            need = set(plain_words(template))
            share = len(have & need) / len(need)
            if share >= 0.8 - 1e-9:
                found[label, at, n] = max(share, found.get((label, at, n), 0))
    return found


LICENSED = [
    "All rights reserved. all  RIGHTS-reserved", "cc by cc by cc by", "Released under\nthe MIT License", "über cc bye CC BY",
    "Released under the MIT License, or the Apache License version 2.0 where licensed", "", None, "cc", "a\0b all rights reserved\n",
    "This work is licensed under the GNU General Public License, version 3. " * 300, "permission " * 9000,
    "in Redistribution and use source binary forms with or without modification are permitted provided that following",
]


def test_licenses(spark):
    docs = spark.createDataFrame(list(enumerate(LICENSED)) + [(None, "CC BY")], "doc_id long, text string")
    rows = licenses.scan_licenses(docs).collect()
    assert {r.doc_id: tuple(r)[1:6] for r in rows} == {r.doc_id: plain_license(r.text) for r in docs.collect()}
    # A window that tells may stand beside the blocks; what it adds is never below the threshold.
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in rows:
        got, want = {(m.label, m.block, m.lines): m.containment for m in r.matches}, plain_matches(texts[r.doc_id])
        assert {k: got.get(k) for k in want} == pytest.approx(want)
        assert all(m.tells and m.containment >= 0.8 for m in r.matches if (m.label, m.block, m.lines) not in want)
        assert set(r.labels.split(",")) - {""} == {m.label for m in r.matches if m.tells} | set(r.base_labels.split(",")) - {""}
    assert [r.labels for r in sorted(rows, key=lambda r: r.doc_id if r.doc_id is not None else -1)][3] == "mit"


def test_no_block_at_the_threshold_is_lost(spark):
    """Blocks with a tenth of a template's words left out and others put in, on one line and wrapped."""
    import random

    rng, texts = random.Random(8), []
    for _, template in [*licenses.TEMPLATES.items(), *licenses.HEADERS, *licenses.SHORT, *licenses.sections(0.8)]:
        for inserted in (0, 0.3, 0.6):
            words = [w for word in template.split() if rng.random() > 0.1 for w in ([f"x{rng.randrange(99)}", word] if rng.random() < inserted else [word])]
            texts += [" ".join(words), "\n".join(" ".join(words[i:i + 8]) for i in range(0, len(words), 8))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in licenses.scan_licenses(docs).collect():
        got = {(m.label, m.block, m.lines): m.containment for m in r.matches}
        want = plain_matches(texts[r.doc_id])
        assert {k: got.get(k) for k in want} == pytest.approx(want)


def test_license_tables(spark, awkward, empty):
    rows = licenses.scan_licenses(awkward).collect()
    assert len(rows) == awkward.count() and licenses.scan_licenses(empty).count() == 0
    clash = spark.createDataFrame([(1, "MIT License", "x", 2.0)] * 2, "doc_id long, text string, labels string, score double")
    assert [(r.labels, r.score) for r in licenses.scan_licenses(clash).collect()] == [("mit", 1.0)] * 2


def test_private_data_tables(spark, awkward, empty):
    assert len(pii.scan_private_data(awkward).collect()) == awkward.count()
    assert pii.scan_private_data(empty).count() == 0
    clash = spark.createDataFrame([(1, "a@b.org", "x")] * 2, "doc_id long, text string, found string")
    assert [[s.kind for s in r.found] for r in pii.scan_private_data(clash).collect()] == [["email"], ["email"]]


def labels_of(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.labels for r in licenses.scan_licenses(docs, phrases={}).orderBy("doc_id").collect()]


def test_license_texts_and_other_notices(spark):
    from pathlib import Path

    files = sorted((Path(licenses.__file__).parent / "license_texts").glob("*.txt"))
    texts = [p.read_text() for p in files]
    assert labels_of(spark, texts) == [p.stem for p in files]
    joined = ["\n".join(" ".join(part.split()) for part in t.split("\n\n")) for t in texts]
    assert labels_of(spark, joined) == [p.stem for p in files]
    others = [
        "Released under the BSD License", "Licensed under CC BY 4.0", "Licensed under CC BY-NC 3.0", "Licensed under the Apache License, Version 1.1",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
        "Licensed under the GNU Lesser General Public License, version 3", "Released under the MIT License",
        "Licensed under the GNU General Public License, version 2", "Licensed under CC BY-NC 4.0",
    ]
    assert labels_of(spark, others) == ["", "", "", "", "", "", "mit", "gpl-2.0", "cc-by-nc-4.0"]
    short = ["MIT License", "// SPDX-License-Identifier: MIT", "GNU GPL v3", "Apache 2.0", "BSD 3-Clause License", "2.0 by Apache", "License mit"]
    assert labels_of(spark, short) == ["mit", "mit", "gpl-3.0", "apache-2.0", "bsd-3-clause", "", ""]


def test_wrapped_notices(spark):
    import textwrap

    texts, want = [], []
    for label, notice in [*licenses.TEMPLATES.items(), *licenses.HEADERS]:
        for mark in ("", "// ", " * ", "# "):
            for width in (30, 72):
                lines = textwrap.wrap(f"Copyright 2020 somebody. {notice}. And so on with more words here.", width)
                texts.append("\n".join(mark + line for line in ["int x;", "", *lines, "", "int y;"]))
                want.append(label)
    assert [set(x.split(",")) for x in labels_of(spark, texts)] == [{x} for x in want]


def test_license_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op8_license_scan"].run(spark, SF).collect():
        assert tuple(r)[1:6] == plain_license(texts[r.doc_id])
        got = {(m.label, m.block, m.lines): m.containment for m in r.matches}
        want = plain_matches(texts[r.doc_id])
        assert {k: got.get(k) for k in want} == pytest.approx(want)
        assert 0 <= r.score <= 1


def test_language_accuracy_on_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = QUERIES["op9_language_id"].run(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id")
    right, total, out = got.where("held_out").agg(
        F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*"), F.sum(F.col("rejected").cast("int"))
    ).first()
    assert right / total > 0.98 and out == 0
    want = docs.select("doc_id", (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2).alias("h"))
    assert got.join(want, "doc_id").where("h <> held_out").count() == 0


def test_language_edges(spark, awkward, empty):
    model = langid.fit(spark.read.parquet(f"{SF}/documents.parquet"))
    got = [(r.lang_pred, r.score, r.rejected) for r in langid.identify(awkward, model).orderBy("doc_id").collect()]
    assert len(got) == awkward.count()
    rows = {r.doc_id: r for r in langid.identify(awkward, model).collect() if r.doc_id is not None}
    for doc in (5, 6, 12):
        assert (rows[doc].lang_pred, rows[doc].score, rows[doc].rejected) == ("und", 0.0, True)
    assert langid.identify(empty, model).count() == 0
    nothing = langid.fit(empty)
    assert {r.lang_pred for r in langid.identify(awkward, nothing).collect()} == {"und"}
    foreign = spark.createDataFrame([(1, "жшщ ыъэ юяё " * 50)], "doc_id long, text string")
    assert langid.identify(foreign, model).first().rejected


def test_language_parts_of_long_texts(spark, monkeypatch):
    model = langid.fit(spark.read.parquet(f"{SF}/documents.parquet"))
    texts = [langid.clean(PROSE * 40), langid.clean("la casa que las ciones")]
    whole, _ = model.cross_entropy(texts)
    monkeypatch.setattr(langid, "SLICE", 97)
    parts, _ = model.cross_entropy(texts)
    assert abs(whole - parts).max() < 1e-4


def test_language_model_sums_to_one(spark):
    model = langid.fit(spark.read.parquet(f"{SF}/documents.parquet"))
    letters = sorted({c for r in spark.read.parquet(f"{SF}/documents.parquet").collect() for c in langid.clean(r.text)})
    import numpy as np

    chars, starts = langid.stream(["the " + c for c in letters])
    hashes = langid.gram_hashes(chars)
    at = starts + 4
    p = np.exp(model.log_probs([h[at] for h in hashes] + [h[at - 1] for h in hashes]).astype(float)).sum(axis=0)
    assert (p < 1.02).all() and (p > 0.9).all()


def plain_lm(docs, order=3):
    tokens = [re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for t in docs]
    counts = Counter(tuple(w[i:i + n]) for w in tokens for n in range(1, order + 1) for i in range(len(w) - n + 1))
    total = sum(map(len, tokens))
    out = []
    for w in tokens:
        score = 0.0
        for i in range(len(w)):
            size = min(i + 1, order)
            lost = 0
            while size > 1 and counts[tuple(w[i - size + 1:i + 1])] < lm.MIN_COUNT:
                size, lost = size - 1, lost + 1
            gram = tuple(w[i - size + 1:i + 1])
            below = counts[gram[:-1]] if size > 1 else total
            score += math.log(counts[gram] / below) + lost * math.log(lm.BACKOFF)
        out.append((len(w), score))
    return out


@pytest.mark.parametrize("block", [60, 8_000_000])
def test_lm_scores(spark, awkward, empty, monkeypatch, block):
    monkeypatch.setattr(lm, "BLOCK_BYTES", block)
    monkeypatch.setattr(lm, "BUCKET_GRAMS", 5_000)
    docs = awkward.where("length(text) < 20000 OR text IS NULL")
    rows = docs.collect()
    got = sorted((str(r.doc_id), r.n_words, round(r.log_score, 3)) for r in lm.score_documents(docs).collect())
    assert got == sorted((str(r.doc_id), n, round(s, 3)) for r, (n, s) in zip(rows, plain_lm([r.text for r in rows])))
    assert lm.score_documents(empty).count() == 0


def test_lm_long_text(awkward):
    got = {r.doc_id: r for r in lm.score_documents(awkward).collect()}
    assert got[10].n_words == 60_000 and got[11].n_words == 3000 and got[5].mean_log is None


ITEM = "when the river rose above the old stone bridge seven men carried their boats up the hill and waited for dawn"


def test_passages(spark, empty):
    words = ITEM.split()
    edited = " ".join("altered" if i % 6 == 5 else w for i, w in enumerate(words))
    shorter = " ".join(w for i, w in enumerate(words) if i % 8 != 3)
    docs = spark.createDataFrame([
        (1, f"{PROSE} {ITEM} {PROSE}"), (2, f"{PROSE}. {edited.upper()}; {PROSE}"), (3, f"{PROSE} {shorter}"),
        (4, PROSE), (5, " ".join(words[:6])), (6, ""), (7, None), (None, ITEM), (8, f"{ITEM} x " * 500), (8, f"{ITEM} x " * 500),
        (9, PROSE * 2000),
    ], "doc_id long, text string")
    items = spark.createDataFrame(
        [(1, ITEM), (2, ITEM), (3, None), (4, ""), (5, "two words"), (None, "nobody ever wrote these few words down")],
        "item_id long, text string",
    )
    got = decontaminate.find_passages(docs, items).collect()
    assert sorted((str(r.doc_id), r.item_id) for r in got) == sorted(
        (d, i) for d in ("1", "2", "3", "8", "8", "None") for i in (1, 2)
    )
    exact = next(r for r in got if r.doc_id == 1)
    assert (exact.score, exact.first_word, exact.last_word) == (1.0, len(PROSE.split()), len(PROSE.split()) + len(words) - 1)
    assert sorted(r.doc_id for r in decontaminate.drop_contaminated(docs, items).collect()) == [4, 5, 6, 7, 9]
    assert decontaminate.find_passages(empty, items).count() == 0
    assert decontaminate.find_passages(docs, items.where("false")).count() == 0
    assert decontaminate.drop_contaminated(docs, items.where("false")).count() == 11


def test_passages_in_parts(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    whole = sorted(tuple(r) for r in decontaminate.find_passages(docs, items).collect())
    held = [(r.item_id, decontaminate.words_of(r.text)) for r in items.collect()]
    want = set()
    for r in docs.collect():
        line = f" {' '.join(decontaminate.words_of(r.text))} "
        want |= {(r.doc_id, i) for i, w in held if f" {' '.join(w)} " in line}
    assert {r[:2] for r in whole} == want
    monkeypatch.setattr(decontaminate, "PART_BYTES", 3_000)
    assert sorted(tuple(r) for r in decontaminate.find_passages(docs, items).collect()) == whole


def test_alignment_by_table():
    import random

    import numpy as np

    rnd = random.Random(3)
    for _ in range(40):
        a = [rnd.randrange(4) for _ in range(rnd.randrange(1, 9))]
        b = [rnd.randrange(4) for _ in range(rnd.randrange(1, 12))]
        h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                h[i][j] = max(0, h[i - 1][j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
        assert decontaminate.align(np.array(a), np.array(b))[0] == max(map(max, h))


PAGE = """<html><head><title>t</title><style>p{}</style><script>var a="</p>";</script></head><body>
<header>Site</header><nav><ul><li><a href=x>Home</a></li></ul></nav><div class="cookie-banner">We use cookies</div>
<article><h1>A &amp; B</h1><p>One <b>bold</b>
 word.<br>Two<p>Three&nbsp;&eacute;<aside>aside</aside><form><input>f</form><div id="comments">reader</div></article>
<footer>foot</footer></body>"""


# Broken pages and their texts.
BROKEN = {
    "<![foo[x]]>": "", "<![ x": "", "a<!-- open": "a", "a<!x": "a", "<!>b": "b", "<![CDATA[ e ]]>f": "f", "<?php x ?>d": "d",
    "<!-->g": "g", "<!--->h": "h", "<!-- x --!>i": "i", "<script>'<!--'</script>j": "j", "<a title='<!-- '>k</a>": "k",
    "l<script>never": "l", "m<style>p{": "m", "<": "<", "n<a": "n", 'o<a href="x': "o", "&#xFFFFFFFF;&#0;&bad;p": "\ufffd\ufffd&bad;p",
    "<p <p>q": "q", "</p>r</html>s": "rs", "<!--[if IE]>w<![endif]-->x<![endif]>y": "xy", "<!DOCTYPE html>t": "t", "</div></div>u": "u",
    "<table><tr><p>v</td></p>w": "v w", "1 < 2 <!-- z --> 3": "1 < 2 3", "<!" * 500: "", "<div>" * 3000 + "x": "x",
}


def test_broken_pages(spark):
    texts = list(BROKEN)
    pages = spark.createDataFrame([(i, f"h{i}", t) for i, t in enumerate(texts)], "page_id long, url string, html string")
    got = {texts[r.page_id]: r.text for r in html.extract_text(pages).collect()}
    assert got == BROKEN


def test_deep_and_open_pages_take_linear_time():
    import time

    start = time.time()
    assert len(html.blocks_of('<div class="ad">x' * 40_000)) == 40_000
    assert html.blocks_of("y" + "<!-- " * 200_000) == [("y", False, False)]
    assert time.time() - start < 20


def test_article_pages(spark):
    rows = [(1, "http://a.b/x", PAGE), (2, None, None), (None, "u", ""), (3, "a.b/y", "plain words only"), (3, "a.b/y", "plain words only")]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")
    got = sorted((str(r.page_id), r.text) for r in html.extract_text(pages).collect())
    assert got == [("1", "A & B One bold word. Two Three é"), ("2", ""), ("3", "plain words only"), ("3", "plain words only"), ("None", "")]
    assert html.extract_text(pages.where("false")).count() == 0


LONG = "this long running text tells of a river " * 5


@pytest.mark.parametrize("page, want", [
    ("<main class='content has-sidebar'><p>Own words</p><div class='sidebar'>side</div></main>", "Own words"),
    ("<main><article class='post comments-open'><p>Own words</p></article></main>", "Own words"),
    ("<div class='page-with-menu'><div class='menu'>menu</div><article>Own words</article></div>", "Own words"),
    ("<form id='aspnet'><nav>menu</nav><article>Own words<form>Send</form></article></form>", "Own words"),
    ("<div class='widget'><article class='promo'>Own words<div class='share'>Share</div></article></div>", "Own words"),
    ("<article>Own words<article class='comment'>Theirs</article></article><div id='comments'><article>Theirs</article></div>", "Own words"),
    (f"<form><nav>menu</nav><p>{LONG}</p></form>", LONG.strip()),
    ("<p>Own words</p><form>Name <input> Send</form><div class='cookie-banner'>We use cookies</div>", "Own words"),
    ("<body class='no-sidebar'><footer><article>Theirs</article></footer><p>Own words</p>", "Own words"),
])
def test_marks_never_cost_the_article(page, want):
    blocks = html.blocks_of(page)
    article = any(inside and not skipped for _, inside, skipped in blocks)
    assert " ".join(text for text, inside, skipped in blocks if not skipped and inside == article) == want


def test_host_repeats_are_removed(spark):
    menu = "<div>" + " ".join(f"menu{i}" for i in range(12)) + "</div>"
    rows = [
        (h * 100 + i, f"http://h{h}.org/{i}", f"<body>{menu}<p>Page {h} {i} tells its very own story about number {h * 31 + i} today</p>")
        for h in range(2) for i in range(20)
    ]
    rows.append((999, "http://alone.org/", f"<body>{menu}"))
    got = {r.page_id: r.text for r in html.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[107] == "Page 1 7 tells its very own story about number 38 today"
    assert got[999].startswith("menu0")


def test_host_repeats_inside_articles(spark):
    share = "<p>Share this story with your friends by mail or by letter</p>"
    side = "<ul>" + "".join(f"<li>related {k}</li>" for k in range(9)) + "</ul>"
    own = [f"Page {i} tells its very own story about number {i * 31} and {i * 7} and ends in the year {1900 + i}" for i in range(20)]
    rows = [(i, "http://h.org/", f"<main><h1>T {i}</h1><p>{own[i]}</p>{share}<p>Quoted twice {own[i % 10]}</p>{side}</main>") for i in range(20)]
    rows += [(50, "http://h.org/", f"<body><p>{own[0]} and more words</p>{share}")]
    rows += [(100 + i, "http://copy.org/", f"<article><p>Version {i}</p><p>{own[5]}</p><p>{own[6]}</p></article>") for i in range(4)]
    rows += [(200 + i, "http://twice.org/", f"<article><p>{own[i]}</p>{share}</article>") for i in range(2)]
    rows += [(300, "http://same.org/", f"<article><p>{own[1]}</p>{share}</article>")] * 5
    common = "a sentence of eight words that many hosts write"
    rows += [
        (400 + 20 * h + i, f"http://often{h}.org/", f"<article><p>{own[i]}</p><p>{common if i < 4 else 'rare'}</p></article>")
        for h in range(2) for i in range(12)
    ]
    got = {r.page_id: r.text for r in html.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[403] == f"{own[3]} {common}"
    for i in range(20):
        assert got[i] == f"T {i} {own[i]} Quoted twice {own[i % 10]}"
    assert got[50] == f"{own[0]} and more words"
    text = re.sub("<.*?>", "", share)
    assert got[100] == f"Version 0 {own[5]} {own[6]}"
    assert got[201] == f"{own[1]} {text}" and got[300] == f"{own[1]} {text}"


@pytest.mark.parametrize("length", [1, 5, 8])
def test_block_runs_cover_shared_runs(length):
    import random

    rnd = random.Random(length)
    for _ in range(200):
        shared = [" ".join(f"s{rnd.random()}" for _ in range(rnd.randrange(1, 6))) for _ in range(rnd.randrange(1, 7))]
        pages = [[f"a{p}"] * rnd.randrange(3) + shared + [f"b{p}"] * rnd.randrange(3) for p in range(2)]
        keys = {key for _, _, key in html.block_runs(pages[1], length)}
        covered = {i for a, b, key in html.block_runs(pages[0], length) if key in keys for i in range(a, b)}
        at = pages[0].index(shared[0])
        long = sum(len(block.split()) for block in shared) >= length
        assert covered == (set(range(at, at + len(shared))) if long else set())


def test_page_query(spark):
    from html import unescape

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = QUERIES["op4_html_text"].run(spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        inside = re.search(r"<article>(.*?)(</article>|$)", pages[r.page_id], re.S)[1]
        want = " ".join(unescape(re.sub(r"<[^>]+>", " ", re.sub(r"</?b>", "", inside))).split())
        assert (r.text, r.n_chars) == (want, len(want))
