"""The quality cascade and the integer clustering against brute force."""

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemart.llm import centroids
from tidemart.llm.centroids import cluster
from tidemart.llm.quality import FEATURES, RULES, order_rules, quality, repeat_words

from .conftest import document_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def features_by_hand(text):
    t = text or ""
    w = WORD.findall(t)
    runs = Counter(zip(w, w[1:], w[2:]))
    again = {i + k for i in range(len(w) - 2) if runs[tuple(w[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", t)),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(again), "n_lines": len(lines),
            "n_upper": len(re.findall("[A-Z]", t)), "n_lower": len(re.findall("[a-z]", t))}


def fails_by_hand(text):
    f = features_by_hand(text)
    return {"short": f["n_words"] < 50, "repetitive": 100 * f["n_repeat_words"] > 50 * f["n_words"], "symbols": 10 * f["n_symbols"] > f["n_words"],
            "capitals": f["n_upper"] > f["n_lower"], "word_length": not 2 * f["n_words"] <= f["word_chars"] <= 15 * f["n_words"],
            "dup_lines": 2 * f["n_dup_lines"] > f["n_lines"]}


def odd_texts():
    rng = random.Random(3)
    words = lambda n, k: " ".join(rng.choice("abcdefgh") * rng.randint(1, k) for _ in range(n))
    return [words(n, k) for n in (3, 4, 5, 60, 400) for k in (1, 2, 9)] + [
        "A | b " * 40, "*** " * 60, "LOUD WORDS " * 3 + words(60, 8).upper(), "x" * 40 + " y" * 60, "a\n b \na\n\x0b\na", "\x0b\x0c", "😀 é # 日本語 " * 5,
        "\n".join(["the same line here"] * 20 + [words(5, 9) for _ in range(9)])]


@pytest.mark.parametrize("hash_bits", [40, 2, 62])
def test_repeat_words_with_clashing_hashes(spark, hash_bits):
    """With two bits nearly all runs clash, with 62 no place fits: both ways
    round give the exact count."""
    texts = [t for t in odd_texts() + [r[1] or "" for r in document_rows()] if len(t) < 20000]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, text string")
    for r in df.select("text", repeat_words(F.col("text"), hash_bits=hash_bits).alias("n")).collect():
        assert r.n == features_by_hand(r.text)["n_repeat_words"], r.text[:80]


def test_features_and_verdicts(spark, docs):
    more = spark.createDataFrame([(k, t) for k, t in enumerate(odd_texts())], "doc_id long, text string")
    for table in (docs, more):
        out = quality(table, measures=tuple(FEATURES)).select("row.text", "m.*", "failed", "kept").collect()
        assert len(out) == table.count()
        for r in out:
            want = features_by_hand(r.text)
            assert {k: r[k] for k in want} == want
            fails = fails_by_hand(r.text)
            assert r.kept == (not any(fails.values())) and (fails[r.failed] if r.failed else not any(fails.values()))


def test_order_never_changes_the_verdict(docs):
    names = [r.name for r in RULES]
    kept = [sorted((repr(r.id), r.kept) for r in quality(docs, order=o).select(F.col("row.doc_id").alias("id"), "kept").collect())
            for o in (names, names[::-1])]
    assert kept[0] == kept[1]
    failed = {r.failed for r in quality(docs, order=["word_length", "short"]).select("failed").collect()}
    assert failed <= {None, "word_length", "short"}


def test_rules_are_ordered_by_rejection_per_cost():
    # 0 rejects 50 at 10 s, 1 rejects 20 at 1 s, 2 only what 1 rejects, 3 nothing.
    outcomes = {(True, False, False, False): 50, (False, True, True, False): 20, (False, False, False, False): 30}
    assert order_rules(outcomes, [10, 1, 2, 0.5]) == [1, 0, 3, 2]
    assert order_rules({}, [2, 1]) == [1, 0]


def test_no_python_in_the_cascade(docs, no_docs):
    out = quality(docs, measures=("n_words",), order=[r.name for r in RULES])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    assert quality(no_docs).collect() == []


def clusters_by_hand(rows, k, rounds, dim, scale=64):
    import math
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    cent = [v for _, v in order[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(cent))
    for _ in range(rounds):
        groups = [[] for _ in cent]
        for _, v in kept:
            groups[near(v)[1]].append(v)
        cent = [[sum(x) // len(g) for x in zip(*g)] if g else c for g, c in zip(groups, cent)]
    return sorted(((i, near(v)[1], near(v)[0]) for i, v in kept), key=repr), cent


@pytest.mark.parametrize("count", [1, 4, 99])
def test_clusters(spark, count):
    rng = random.Random(7)
    rows = [(i, [rng.choice((0.0, -0.26, 0.51, rng.uniform(-1, 1))) for _ in range(6)]) for i in range(60)]
    rows += [rows[3], rows[3], (None, rows[5][1]), (200, None), (201, [0.1] * 5), (202, [0.1] * 5 + [None]), (203, [0.1] * 5 + [float("nan")]),
             (204, [float("-inf")] * 6), (205, []), (206, [0.0] * 6), (207, [0.0] * 6), (208, [5000.25] * 6)]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, v string, cluster int")
    out, cent = cluster(df.repartition(3), dim=6, count=count, rounds=3)
    want, want_cent = clusters_by_hand([(i, v and [None if x is None else float(x) for x in r]) for (i, v), r in
                                        zip(rows, [r.embedding for r in df.collect()])], count, 3, 6)
    assert sorted(((r.vec_id, r.cluster, r.distance) for r in out.collect()), key=repr) == want and cent == want_cent


def test_dots_are_exact_and_only_moved_components_are_touched(spark, monkeypatch):
    df = spark.createDataFrame([(1, [3, -2]), (2, [0, 7])], "vec_id long, v array<int>")
    first = centroids.assign(df, [[0, 0], [0, 0]], [[1, 1], [0, 5]])
    assert [r.dots for r in first.orderBy("vec_id").collect()] == [[1, -10], [7, 35]]
    wrong = first.withColumn("v", F.expr("array(v[0], 1000)"))  # a component no centroid moves in is never read
    assert [r.dots for r in centroids.assign(wrong, [[1, 1], [0, 5]], [[4, 1], [0, 5]]).orderBy("vec_id").collect()] == [[10, -10], [7, 35]]


def test_cluster_edges(spark):
    schema = "vec_id long, embedding array<float>"
    assert cluster(spark.createDataFrame([], schema))[0].collect() == []
    assert cluster(spark.createDataFrame([(1, None), (2, [1.0])], schema), dim=2)[1] == []
    with pytest.raises(PySparkException, match="distances fit no long"):
        cluster(spark.createDataFrame([(1, [3e38])], schema), dim=1)
