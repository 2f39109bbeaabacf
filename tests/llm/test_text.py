"""Packing, main text, language, licences, mixing and the pipeline."""

import json
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tidemart.llm import langid
from tidemart.llm.html_extract import extract, main_text
from tidemart.llm.license_scan import TEMPLATES, WORD, Scanner, license_scan
from tidemart.llm.mixing import emit, mix, targets
from tidemart.llm.packing import cuts_words, pack
from tidemart.llm.queries import QUERIES

from .conftest import document_rows

PATH = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("window, cache", [(16, 1 << 20), (4096, 40)])
def test_packing(docs, window, cache):
    tokenizer = Tokenizer.from_file(PATH)
    rows = pack(docs, PATH, window=window, cache_words=cache).collect()
    want = Counter((r[0], tuple(tokenizer.encode(r[1] or "", add_special_tokens=False).ids) + (2,)) for r in document_rows())
    by_doc = defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert r.length == len(ids) > 0 and 0 <= r.offset and r.offset + r.length <= window
        by_doc[r.doc_id].append((r.start, r.doc_tokens, ids, r.sequence_id * window + r.offset - r.start))
    # Pieces of one document have one global begin, and cover it without gaps.
    got = Counter()
    for doc, pieces in by_doc.items():
        for begin in {p[3] for p in pieces}:
            ids = []
            for start, n, x, _ in sorted(p for p in pieces if p[3] == begin):
                assert start == len(ids)
                ids += x
            assert len(ids) == n
            got[doc, tuple(ids)] += 1
    assert got == want
    places = sorted((r.sequence_id, r.offset, r.length) for r in rows)
    upto = 0
    for s, o, n in places:
        assert s * window + o == upto
        upto += n


def test_packing_with_any_tokenizer(docs, tmp_path):
    """Files that cut words in another way, or truncate, give the tokenizer's own ids."""
    byte_level = public_tokenizers.path("byte_bpe_50k.json")
    other = json.load(open(PATH, encoding="utf-8"))
    assert cuts_words(other) and not cuts_words(json.load(open(byte_level, encoding="utf-8")))
    other["normalizer"]["normalizers"].pop()  # keeps capitals
    other["truncation"] = {"direction": "Right", "max_length": 5, "strategy": "LongestFirst", "stride": 0}
    capitals = str(tmp_path / "capitals.json")
    with open(capitals, "w", encoding="utf-8") as f:
        json.dump(other, f)
    for path in (byte_level, capitals):
        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        want = Counter((r[0], tuple(tokenizer.encode(r[1] or "", add_special_tokens=False).ids) + (7,)) for r in document_rows())
        got = Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in pack(docs, path, window=1 << 20, end_id=7).collect())
        assert got == want


def test_packing_empty(no_docs):
    assert pack(no_docs, PATH).collect() == []


LONG = "This is running text, with commas, and enough of it to count as a paragraph, surely. "


def test_main_text():
    page = f"""<!DOCTYPE html><html><head><title>No</title><script>var a = "</p>";</script><style>p{{}}</style></head><body>
      <header><h1>Site</h1></header><nav><ul><li><a href="/a">Home</a></li></ul></nav><div class="cookie-notice">We use cookies, many, many of them, really.</div>
      <div id="page"><article class="post"><h1>Title &amp; more</h1><p>{LONG}&eacute;&#233; <b>bold</b><br>line<p>Second&nbsp;one,
      {LONG}<div class="ad">Buy, buy, buy, and then buy some more of it.</div><ul><li>item one</li><li>item two</li></ul><pre>a   b</pre>
      <form><p>Your mail, please, and your name, and more, and more.</p></form></article>
      <div class="sidebar"><p>{LONG * 3}</p></div><section id="comments"><p>{LONG * 9}</p></section></div>
      <footer><p>{LONG}</p></footer></body></html>"""
    long = LONG.strip()
    assert main_text(page) == f"Title & more\n{long} éé bold line\nSecond one, {long}\nitem one\nitem two\na b"


def test_main_text_without_article():
    text = "".join(f"<div class='part'><h2>Part {k}</h2><p>{LONG * 2}</p><p>{LONG}</p></div>" for k in range(3))
    page = f"<body><div class='menu'><a href=x>one</a></div><div><ul><li><a href=1>first page</a><li><a href=2>second page</a></ul></div><div id=story>{text}</div><div class='footer-links'><p>{LONG}</p></div>"
    got = main_text(page).split("\n")
    assert got == [x for k in range(3) for x in (f"Part {k}", (LONG * 2).strip(), LONG.strip())]


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("plain, unmarked text", "plain, unmarked text"), ("<p>short</p>", "short"), ("<article>a<p>b</article>c", "a\nb"),
    ("<script>if (a < b) x()</script>", ""), ("<!-- only -->", ""), ("a < b & c", "a < b & c"), ("<article>&am &amp &lt;p&gt;</article>", "&am & <p>"),
    ("<article><p title='a > b'>x</p><img alt=\"<p>\"></article>", "x"), ("<article><p>a<b>b<i>c</p><p>d</article>", "abc\nd"), ("<div>" * 3000 + "deep", "deep"),
    ("<article hidden>no</article><p>yes", "yes"), ("<p unclosed='", "")])
def test_main_text_cases(page, text):
    assert main_text(page) == text


P = LONG.strip()


def page_around(article, wrap="{}", before="", after=""):
    return f"<html><body><nav><a href=/>home</a></nav>{wrap.format(before + article + after)}<footer>foot</footer></body></html>"


ARTICLE = f"<article><h1>Title</h1><p>{LONG}</p><p>Short end.</p></article>"
STORY = f"<div class=story><h1>Title</h1><p>{LONG}</p><p>Short end.</p></div>"
WRAPS = ["{}", "<div id=page class='site has-sidebar'>{}</div>", "<div class=content-with-comments>{}</div>", "<div class='widget-area'><div class=no-sidebar>{}</div></div>",
         "<main class=sidebar-left>{}</main>", "<div class='page-header-fixed share-enabled'><div>{}</div></div>"]
ASIDES = [("", ""), ("<div class=ad>Buy, buy, buy.</div>", f"<div id=comments><article><p>{LONG * 9}</p></article></div>"),
          (f"<div class=sidebar><p>{LONG * 4}</p></div>", ""), ("<header>Site</header>", f"<section class='comments-area comment-list'><p>{LONG * 2}</p></section>"),
          ("<button>Menu</button>", "<ul class=x><li><a href=1>one</a><li><a href=2>two</a></ul>")]


@pytest.mark.parametrize("wrap", WRAPS)
@pytest.mark.parametrize("aside", range(len(ASIDES)))
def test_layouts(wrap, aside):
    """A class word around the article never takes it away, and furniture in
    the same wrapper goes."""
    assert main_text(page_around(ARTICLE, wrap, *ASIDES[aside])) == f"Title\n{P}\nShort end."


@pytest.mark.parametrize("wrap", [w for w in WRAPS if "main" not in w])
@pytest.mark.parametrize("before, after", [("", ""), ("<div class=ad>Buy, buy, buy.</div>", "<div id=comments><p>Me too.</p></div>")])
def test_layouts_without_article(wrap, before, after):
    assert main_text(page_around(STORY, wrap, before, after)) == f"Title\n{P}\nShort end."


def test_siblings_and_inline_parts_stay():
    stories = f"<div class=story><p>{LONG * 3}</p></div><div class=story><p>{LONG}</p></div><div class=story><p>The end.</p></div>"
    assert main_text(f"<body><div id=all>{stories}</div></body>") == f"{(LONG * 3).strip()}\n{P}\nThe end."
    articles = stories.replace("div", "article")
    assert main_text(f"<body>{articles}</body>") == f"{(LONG * 3).strip()}\n{P}\nThe end."
    inline = f"<article><p>{LONG}Press <button>Go</button> at <label>the label</label>, where <math><mi>x</mi><mo>=</mo><mn>1</mn></math>.</p><form><label>Mail</label></form></article>"
    assert main_text(inline) == f"{P} Press Go at the label, where x=1."


def test_extract_through_spark(spark):
    page = page_around(ARTICLE)
    rows = [(1, page, "a"), (1, page, "a"), (2, None, "b"), (3, "", "c"), (None, "<p>x</p>", None)]
    df = spark.createDataFrame(rows, "page_id long, html string, text string").select("page_id", extract(F.col("html")).alias("main"), "text")
    want = f"Title\n{P}\nShort end."
    assert Counter(tuple(r) for r in df.collect()) == Counter([(1, want, "a"), (1, want, "a"), (2, "", "b"), (3, "", "c"), (None, "x", None)])
    assert df.limit(0).collect() == []


def test_main_text_is_linear():
    import time
    for part in ("<a href='", "<!--", "<script>", "<p>x", "</p>", "<<<", "&amp;"):
        t = time.time()
        main_text(part * 20000)
        assert time.time() - t < 20


def test_language(docs, no_docs, spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit(table)
    got = docs.select("doc_id", "text", langid.language(model, docs, F.col("text")).alias("p")).collect()
    for r in got:
        assert 0 <= r.p.score <= 1
        assert (r.p.lang == "und") == (r.text is None or not any(c.isalpha() for c in r.text))
        assert r.p.lang in [*model.languages, "und"]
    empty = langid.fit(no_docs)
    assert empty.languages == []
    assert {r.p.lang for r in docs.select(langid.language(empty, docs, F.col("text")).alias("p")).collect()} == {"und"}


def test_language_chunks(monkeypatch):
    model = langid.train(["the cat sat on the mat " * 9, "le chat est sur la table " * 9] * 10, ["en", "fr"] * 10)
    text = ("the cat and the dog " * 300).encode()
    whole = langid.logits(model, text)
    monkeypatch.setattr(langid, "CHUNK", 17)
    assert np.allclose(whole, langid.logits(model, text), atol=1e-4)
    assert langid.predict(model, text)[0] == "en" and langid.predict(model, b"12 !!") == ("und", 0.0)


def test_language_rejects_noise(spark):
    """The rejection score leaves real texts alone and takes noise."""
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(table.filter(~langid.held_out(F.col("doc_id"))))
    assert 0.25 < model.reject < 1 and model.noise_rejected > 0.9
    real = [r for r in table.filter(langid.held_out(F.col("doc_id")) & F.col("lang").isNotNull()).collect() if len(r.text) > 30]
    assert np.mean([langid.predict(model, r.text.encode())[1] < model.reject for r in real]) < 0.005
    rng = np.random.default_rng(5)
    junk = [langid.noise(r.text, [chr(c) for c in range(0x561, 0x581)], rng) for r in real]
    assert np.mean([langid.predict(model, t.encode())[1] < model.reject for t in junk]) > 0.95


def test_language_samples_windows_from_whole_texts(spark):
    long = "".join(f"{i:05d}x" for i in range(2000))
    got = langid.training_sample(spark.createDataFrame([(long + str(k), "en") for k in range(40)] + [("short", "fr"), (None, "fr"), ("x", None)], "text string, lang string"),
                                 "text", "lang", 1000, 60)
    places = [int(re.search(r"(\d{5})x", t)[1]) for t in got[got["label"] == "en"]["text"]]
    assert all(len(t) == 60 for t in got[got["label"] == "en"]["text"]) and max(places) > 1500 and min(places) < 500
    assert got[got["label"] == "fr"]["text"].tolist() == ["short"]


def test_language_held_out(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op3_language_id"](spark, sf).toPandas().merge(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").toPandas())
    fold = [zlib.crc32(str(i).encode()) % 4 == 2 for i in got["doc_id"]]
    assert got["held_out"].tolist() == fold
    held = got[got["held_out"] & got["lang"].notna()]
    assert (held["lang"] == held["lang_pred"]).mean() > 0.95


def licences_by_hand(text, need):
    """Best coefficient of any span of words with any template."""
    w, best = WORD.findall((text or "").lower()), {}
    for name, texts in TEMPLATES.items():
        for t in texts:
            g = WORD.findall(t.lower())
            g = set(zip(g, g[1:]))
            if len(g) > 14:
                continue
            for i in range(len(w)):
                for e in range(i + 1, min(len(w), i + 2 * len(g) + 2)):
                    s = set(zip(w[i:e], w[i + 1:e + 1]))
                    d = 2 * len(s & g) / (len(s) + len(g))
                    if d >= need:
                        best[name] = max(best.get(name, 0), d)
    return best


@pytest.mark.parametrize("text", [
    "Some text here.\nReleased under the MIT License.\nMore text.", "Licensed under CC BY-NC 4.0.", "this  work is LICENSED under the gnu general public license (version 3)",
    "Licensed under the Apache License, Version 2.0.", "nothing of the kind, all is well under the sun", "", None, "All rights reserved",
    "Licensed under the MIT License. And also licensed under CC BY-SA 4.0."])
def test_licences(text):
    found, want = Scanner(TEMPLATES, 0.8).scan(text), licences_by_hand(text, 0.8)
    assert bool(found) == bool(want)
    for name, dice, a, b in found:
        assert abs(want[name] - dice) < 1e-9 and dice == max(want.values()) and WORD.fullmatch(text.lower()[a:b].split()[0].strip('("'))


def spans_by_hand(scanner, text):
    """All spans of all templates that reach the coefficient, then the best
    ones that share no word."""
    w, spans = WORD.findall(text.lower()), []
    for k, g in enumerate(scanner.grams):
        for i in range(len(w) - 1):
            n = set()
            for e in range(i, min(len(w) - 1, i + 2 * len(g) + 1)):
                if (w[e], w[e + 1]) not in n:
                    n.add((w[e], w[e + 1]))
                    if (w[e], w[e + 1]) in g and (w[i], w[i + 1]) in g and (d := 2 * len(n & g) / (len(n) + len(g))) >= scanner.min_dice:
                        spans.append((-d, i - e, k, i, e + 1))
    kept = []
    for s in sorted(spans):
        if all(s[4] < x[3] or x[4] < s[3] for x in kept):
            kept.append(s)
    return [(scanner.names[k], -d, i, e) for d, _, k, i, e in sorted(kept, key=lambda x: x[3])]


@pytest.mark.parametrize("seed", range(len(TEMPLATES)))
def test_licences_among_prose(seed):
    """Every template, whole and edited, between sentences that hold some of
    its words: the prose takes nothing from the coefficient."""
    rng = random.Random(seed)
    scanner = Scanner(TEMPLATES, 0.8)
    name = list(TEMPLATES)[seed]
    for t in TEMPLATES[name]:
        own = t.split()
        prose = lambda n: " ".join(rng.choice([*own, "code", "of the", "tea"]) for _ in range(n))
        edited = " ".join(x for x in own if rng.random() > 0.05)
        text = f"{prose(15)} qed {t} qed {prose(12)} qed {edited} qed {t} {t} qed {prose(5)}"
        got = scanner.scan(text)
        at = {m.start(): i for i, m in enumerate(WORD.finditer(text.lower()))}
        till = {m.end(): i for i, m in enumerate(WORD.finditer(text.lower()))}
        assert [(n, d, at[a], till[b]) for n, d, a, b in got] == spans_by_hand(scanner, text)
        # Some licences' words differ in a version or kind only, so their templates hold the others' bigrams.
        assert sum(d == 1 for _, d, _, _ in got) >= 3


def test_licence_texts(docs, no_docs, spark):
    full = TEMPLATES["BSD-3-Clause"][0]
    edited = " ".join(w for i, w in enumerate(full.split()) if i % 25)
    rows = [(1, f"code code\n{full}\nmore code"), (2, edited), (3, full[:200]), (4, full.replace(" ", "\n"))]
    got = {r.doc_id: r for r in license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].license == got[4].license == got[2].license == "BSD-3-Clause" and got[1].dice == 1 and 0.8 <= got[2].dice < 1
    assert got[3].license is None and got[3].n_matches == 0
    assert license_scan(docs).count() == len(document_rows()) and license_scan(no_docs).collect() == []


def filled_by_hand(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """Share again and again what goes over a cap."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out, rest = dict.fromkeys(names, 0.0), share * sum(sizes.values())
    for _ in range(len(names) + 1):
        left = [s for s in names if out[s] < most * sizes[s] - 1e-9]
        if not left or rest <= 1e-9:
            break
        total, spent = sum(w[s] for s in left), 0.0
        for s in left:
            more = min(rest * w[s] / total, most * sizes[s] - out[s])
            out[s] += more
            spent += more
        rest -= spent
    return out


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 5, "c": 40, "d": 7, None: 30}, {"a": 10}, {"a": 0, "b": 10}, {"a": 0}, {"é": 1, "z": 50, "Z": 50, "y": 1000}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in targets(df).collect()}
    want = filled_by_hand(sizes)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in got)


def test_mix(docs, no_docs):
    rows = mix(docs).select("row.doc_id", "row.text", "row.source", "row.size", F.col("size").alias("words"), "source_size", "target", "copies").collect()
    sizes = defaultdict(int)
    for r in document_rows():
        sizes[r[3]] += len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    want = filled_by_hand(sizes)
    for r in rows:
        assert r.words == len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) and r.source_size == sizes[r.source]
        assert abs(r.target - want[r.source]) < 1e-6
        rate = r.target / r.source_size if r.source_size else 0
        assert r.copies in (int(rate), int(rate) + 1) and r.copies <= 2
    out = emit(mix(docs))
    assert out.columns == docs.columns and out.count() == sum(r.copies for r in rows)
    assert mix(docs).select("copies").collect() == mix(docs).select("copies").collect()
    assert mix(no_docs).collect() == []


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "line_dedup", "near_dedup", "mixing", "packing"]
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, before, SF)
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        assert out.columns == docs.columns and out.count() > 0
        assert {r.doc_id for r in out.collect()} <= {r.doc_id for r in before.collect()}
        before = out
    rows = corpus_pipeline.run(spark, SF).collect()
    words = {r.doc_id: r.text for r in before.collect()}
    tokenizer = Tokenizer.from_file(PATH)
    assert Counter(r.doc_id for r in rows if r.start == 0) == Counter(r.doc_id for r in before.collect())
    assert all(r.doc_tokens == len(tokenizer.encode(words[r.doc_id], add_special_tokens=False).ids) + 1 for r in rows)


def test_pipeline_stages_on_edge_cases(spark, docs, no_docs, tmp_path):
    for k, table in enumerate((docs, no_docs)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, table, SF)
            out.write.parquet(str(tmp_path / f"{k}-{name}"))
            if name != "packing":
                assert out.columns == docs.columns
