"""The transducer vocabulary and the divergence audit against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemart.llm.divergence import Transducer, _share, divergence, term_spans, transducers

from .conftest import document_rows

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def minimal_states(words):
    """How many different sets of endings the words' beginnings have."""
    endings = defaultdict(set)
    for w in words:
        for k in range(len(w) + 1):
            endings[w[:k]].add(w[k:])
    return len({frozenset(e) for e in endings.values()})


@pytest.mark.parametrize("seed", range(4))
def test_transducer(seed):
    rng = random.Random(seed)
    words = sorted({"".join(rng.choice("abé日") for _ in range(rng.randint(1, 7))).encode() for _ in range(300)} | {b"a", b"ab", b"abc"})
    t = Transducer.from_bytes(Transducer.build(words).to_bytes())
    assert t.terms == len(words) and len(t.final) == minimal_states(words)
    assert [t.term(k) for k in range(len(words))] == words
    other = [w + b"a" for w in words] + [w[:-1] for w in words if len(w) > 1] + [b"zz"]
    text = np.frombuffer(b" ".join(words + other), np.uint8)
    starts, lengths = term_spans(text)
    want = {w: k for k, w in enumerate(words)}
    held = [want.get(bytes(text[a:a + n]), -1) for a, n in zip(starts, lengths)]
    assert t.ordinals(text, starts, lengths).tolist() == held and -1 in held


def test_transducer_needs_sorted_terms():
    for terms in ([b"b", b"a"], [b"a", b"a"]):
        with pytest.raises(AssertionError):
            Transducer.build(terms)


def test_spans_are_the_terms():
    for text in ("", "a", "Ab1c-dé_f", "\x00日本\x7f語 ß", "😀x😀"):
        b = text.encode()
        starts, lengths = term_spans(np.frombuffer(b, np.uint8))
        assert [b[a:a + n].decode() for a, n in zip(starts, lengths)] == TERM.findall(text)


def audit_by_hand(rows, min_docs, top):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs = [(r[2] or "", r[3] or "", TERM.findall((r[1] or "").translate(lower))) for r in rows]
    out = []
    for lang in {d[0] for d in docs}:
        df = Counter(t for d in docs if d[0] == lang for t in set(d[2]))
        kept = sorted((t for t, n in df.items() if n >= min_docs), key=str.encode)
        groups = defaultdict(Counter)
        for _, source, terms in (d for d in docs if d[0] == lang):
            groups[source].update(t for t in terms if df[t] >= min_docs)
        share = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept)) for t in kept}
        p, q = {s: share(c) for s, c in groups.items()}, share(sum(groups.values(), Counter()))
        for s in groups:
            pairs = [(x, sum(abs(p[s][t] - p[x][t]) for t in kept)) for x in groups if x != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if groups[s][t] > 0 and p[s][t] > q[t]]
            for part, items in (("pair", pairs), ("term", terms)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, v, k + 1) for k, (item, v) in enumerate(ranked) if part == "pair" or k < top]
    return sorted(out)


def generated(n, sources):
    rng = random.Random(n)
    words = ["".join(rng.choice("abcDEé") for _ in range(rng.randint(1, 4))) for _ in range(120)]
    rows = []
    for i in range(n):
        s = f"s{rng.randrange(sources)}"
        text = " ".join(rng.choice(words[: 40 + 10 * (hash(s) % 5)]) for _ in range(rng.randint(0, 80)))
        rows.append((i, rng.choice((text, text, None)) if i % 9 == 0 else text, rng.choice(("en", "en", "en", "fr", None)), rng.choice((s, s, "s0", None))))
    return rows


SMALL = {"shard_bytes": 40, "most_bytes": 3000, "block": 8, "side": 3}


@pytest.mark.parametrize("sizes", [{}, SMALL], ids=["production", "many shards, rounds and tiles"])
@pytest.mark.parametrize("rows", [generated(150, 9), document_rows()], ids=["generated", "odd rows"])
def test_audit(spark, rows, sizes):
    df = spark.createDataFrame([(r[0], r[1], r[2], r[3], "x", 1, "y") for r in rows],
                               "doc_id long, text string, lang string, source string, term string, shard int, value string").repartition(3)
    got = sorted(tuple(r) for r in divergence(df, min_docs=4, top=5, **sizes).collect())
    assert got == audit_by_hand(rows, 4, 5)


def test_long_texts_are_cut_between_terms(spark, monkeypatch):
    from tidemart.llm import divergence as module
    text = ("word other " * 40 + "x" * 300 + " ") * 3
    rows = [(i, text, "en", f"s{i % 2}") for i in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    shards = transducers(module.kept_terms(df, 2), 1 << 20)
    counts = module._count_round(df, shards, [("en", 0)], chunk=64, hold=1)
    got = {r.ordinal: r.n for r in counts.groupBy("ordinal").agg(F.sum("n").alias("n")).collect()}
    assert got == {0: 480, 1: 480, 2: 12}


def test_shares_are_exact_beyond_longs(spark):
    n, total, terms = 7 * 10**15 + 3, 10**16 + 1, 10**9 + 7
    df = spark.createDataFrame([(n, total, terms)], "n long, total long, terms long")
    assert df.select(_share(F.col("n"), F.col("total"), F.col("terms"))).first()[0] == 1 + 10**9 * (n + 5) // (total + 5 * terms)


def test_empty_and_termless(spark, no_docs):
    assert divergence(no_docs).collect() == []
    df = spark.createDataFrame([(1, None, "en", "a"), (2, "...", "en", "b"), (3, "x", "fr", None)], "doc_id long, text string, lang string, source string")
    assert sorted(tuple(r) for r in divergence(df, min_docs=2).collect()) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_best_terms_are_cut_before_the_shuffle(docs):
    from pyspark.sql import Window as W
    best = W.partitionBy("lang").orderBy("n_chars")
    plan = docs.withColumn("rank", F.row_number().over(best)).filter("rank <= 50")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
