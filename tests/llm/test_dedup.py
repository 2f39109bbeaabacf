"""Exact, line, suffix, SimHash and vector duplicates against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemart.llm.common import connected_components, small_batches
from tidemart.llm.embed_dedup import embedding_links
from tidemart.llm.exact_dedup import exact_dedup
from tidemart.llm.line_dedup import line_dedup
from tidemart.llm.simhash import near_pairs, simhash_dedup, simhash_groups
from tidemart.llm.suffix_dedup import suffix_dedup

from .conftest import document_rows


def counted(rows):
    return Counter(tuple(r) for r in rows)


def exact_by_hand(rows):
    groups = defaultdict(list)
    for n, r in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0D]", "", r[1] or "")].append((-len(r[1] or ""), r[0] is None, r[0] or 0, n, r[0]))
    out = []
    for bare, g in groups.items():
        best = min(g)
        out += [(x[4], best[4], len(g), x is best, hashlib.sha256(bare.encode()).hexdigest()) for x in sorted(g)]
    return Counter(out)


@pytest.mark.parametrize("key", [None, lambda c: F.pmod(F.xxhash64(c), F.lit(3))], ids=["hash", "clashing keys"])
def test_exact(docs, key):
    out = exact_dedup(docs, block_bytes=64, **({"key": key} if key else {}))
    assert counted(out.collect()) == exact_by_hand(document_rows())


def test_exact_empty(no_docs):
    assert exact_dedup(no_docs).collect() == []


def lines_by_hand(rows, min_words):
    """A line goes if a run of lines around it with enough words stood before."""
    order = sorted(range(len(rows)), key=lambda n: (rows[n][0] is None, rows[n][0] or 0))
    seen, out = {}, []
    for n in order:
        text = rows[n][1]
        parts = text.split("\n") if text is not None else []
        place = [i for i, x in enumerate(parts) if re.search(r"[^\x20\x09-\x0D]", x)]
        gone = set()
        for a in range(len(place)):
            for b in range(a, min(len(place), a + 40)):
                run = tuple(parts[i] for i in place[a:b + 1])
                if sum(len(x.encode().split()) for x in run) < min_words:
                    continue
                if run in seen and seen[run] != (n, a):
                    gone.update(range(place[a], place[b] + 1))
                seen.setdefault(run, (n, a))
        left = [x for i, x in enumerate(parts) if i not in gone]
        out.append((rows[n][0], None if text is None else "\n".join(left), len(parts), len(gone)))
    return Counter(out)


@pytest.mark.parametrize("min_words", [1, 3, 10])
def test_lines(docs, min_words):
    out = line_dedup(docs, min_words=min_words).select("row.doc_id", "text", "n_lines", "n_deleted")
    assert counted(out.collect()) == lines_by_hand(document_rows(), min_words)


def test_lines_runs_and_empty(docs, no_docs):
    rows = line_dedup(docs).select("row.doc_id", "row.size", "runs", "emptied", "n_deleted").collect()
    assert all(r.n_deleted == sum(x.last - x.first + 1 for x in r.runs) for r in rows)
    assert [r.size for r in rows if r.doc_id == 4] == ["1"]  # the input's own column, not the operator's
    assert {r.doc_id for r in rows if r.emptied} >= {13}
    assert line_dedup(no_docs).collect() == []


def suffixes_by_hand(rows, width):
    data = [(r[0], (r[1] or "").encode()) for r in rows]
    seen = Counter(b[s:s + width] for _, b in data for s in range(len(b) - width + 1))
    out = []
    for i, b in data:
        hit = np.zeros(len(b) + 1, bool)
        for s in range(len(b) - width + 1):
            if seen[b[s:s + width]] > 1:
                hit[s:s + width] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[False], hit]).astype(int)))
        spans = tuple((int(a), int(e)) for a, e in edges.reshape(-1, 2))
        out.append((i, len(b), spans, bytes(x for x, h in zip(b, hit) if not h)))
    return Counter(out)


@pytest.mark.parametrize("width, gram", [(200, 48), (40, 12)])
def test_suffixes(docs, width, gram):
    rows = suffix_dedup(docs, width=width, gram=gram).collect()
    got = Counter((r.doc_id, r.n_bytes, tuple((s.start, s.end) for s in r.spans), bytes(r.kept)) for r in rows)
    assert got == suffixes_by_hand(document_rows(), width)


def spans_of(rows):
    return Counter((r.doc_id, r.n_bytes, tuple((s.start, s.end) for s in r.spans), bytes(r.kept)) for r in rows)


def test_suffixes_of_texts_longer_than_a_chunk(spark):
    # No 200 bytes of these repeat but the planted ones; the runs of many anchors cross the chunks' ends.
    rng = random.Random(3)
    letters = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=n))
    rows = [(i, letters(140_000 + 37 * i)) for i in range(12)]
    rows += [(12, rows[3][1][65_400:65_900]), (13, letters(70_000) + rows[5][1][131_000:131_300] + letters(10))]
    got = spans_of(suffix_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == suffixes_by_hand(rows, 200)


@pytest.mark.parametrize("parts", [2, 40])
def test_suffixes_of_many_small_splits(spark, parts):
    # Several splits' files are read by one task, so one batch of rows holds several splits.
    rng = random.Random(4)
    words = lambda n: " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(n))
    shared = [words(60) for _ in range(5)]
    rows = [(i, f"{words(30)} {shared[i % 7]} {words(i)}" if i % 7 < 5 else words(80)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts, "doc_id")
    assert spans_of(suffix_dedup(docs).collect()) == suffixes_by_hand(rows, 200)


def test_suffixes_empty(no_docs):
    assert suffix_dedup(no_docs).collect() == []


def prints_by_hand(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(n, links):
    root = list(range(n))
    changed = True
    while changed:
        changed = False
        for a, b in links:
            if root[a] != root[b]:
                root[a] = root[b] = min(root[a], root[b])
                changed = True
    return root


def test_simhash(docs, no_docs):
    rows = document_rows()
    fps = [prints_by_hand(r[1]) for r in rows]
    root = components(len(rows), [(a, b) for a in range(len(rows)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 3])
    least = {x: min((rows[i][0] for i in range(len(rows)) if root[i] == x and rows[i][0] is not None), default=None) for x in root}
    got = simhash_groups(docs).collect()
    assert Counter((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in got) == \
        Counter((r[0], f, least[x]) for r, f, x in zip(rows, fps, root))
    kept = simhash_dedup(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(least.values()))
    assert simhash_groups(no_docs).collect() == [] and simhash_dedup(no_docs).collect() == []


def test_small_batches(spark):
    """The session's own size comes back, after an error too."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    with pytest.raises(ZeroDivisionError), small_batches(spark, "1k"):
        assert spark.conf.get(key) == "1k"
        raise ZeroDivisionError
    assert spark.conf.get(key) == before


def test_fingerprint_over_batches(spark):
    """Batches of one text or of many give the same fingerprints."""
    rows = [(i, r[1]) for i, r in enumerate(document_rows())]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    with small_batches(spark, "1k"):
        small = {r.doc_id: r.fp for r in simhash_groups(df).collect()}
    assert small == {i: int(np.uint64(prints_by_hand(t)).astype(np.int64)) for i, t in rows}


@pytest.mark.parametrize("bits", [1, 2, 3, 5])
def test_near_pairs(spark, bits):
    rng = np.random.default_rng(bits)
    seeds = rng.integers(-2**63, 2**63, 12)
    fps = {int(s) for s in seeds}
    for s in seeds:
        for _ in range(6):
            flips = rng.choice(64, rng.integers(1, 8), replace=False)
            fps.add(int(np.bitwise_xor.reduce(np.concatenate([[s], (np.uint64(1) << flips.astype(np.uint64)).view(np.int64)]))))
    got = {(r.a, r.b) for r in near_pairs(spark.createDataFrame([(f,) for f in fps], "fp long"), bits).collect()}
    assert got == {(a, b) for a in fps for b in fps if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= bits}


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, x) for x in range(101, 130)] + [(120, 200), (200, 201), (7, 7), (300, 300), (50, 60), (60, 50)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = sorted({x for e in links for x in e})
    root = components(max(nodes) + 1, links)
    assert got == {n: root[n] for n in nodes}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def vectors():
    rng = np.random.default_rng(3)
    rows = []
    for g in range(12):
        c = rng.normal(size=16)
        for k in range(25 if g == 0 else 6):
            rows.append((len(rows), (c + rng.normal(size=16) * 0.12).tolist(), g % 3))
    rows += [(500 + i, rows[2][1], 0) for i in range(4)] + [(510, rows[2][1], None), (511, None, 0), (512, [], 0), (513, [0.0] * 16, 0),
             (514, [None, *rows[2][1][1:]], 0), (515, [float("nan")] + [1.0] * 15, 0), (516, [float("inf")] + [1.0] * 15, 0), (517, [1.0, 2.0], 0),
             (518, [2.0, 4.0], 0), (519, (np.array(rows[3][1]) * 3).tolist(), 0),
             (520, (np.array(rows[3][1]) * 1e200).tolist(), 0), (521, (np.array(rows[3][1]) * 1e-200).tolist(), 0), rows[5], rows[5], (None, rows[6][1], 0)]
    return rows


def test_vectors(spark, tmp_path):
    rows = vectors()
    unit = []
    for _, v, label in rows:
        ok = label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        v = np.array(v, float) / np.abs(v).max() if ok else None
        unit.append(v / np.linalg.norm(v) if ok else None)
    links = [(a, b) for a in range(len(rows)) for b in range(a) if unit[a] is not None and unit[b] is not None and rows[a][2] == rows[b][2]
             and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.98]
    root = components(len(rows), links)
    count = Counter(x for e in links for x in e)
    least = {x: min((rows[i][0] for i in range(len(rows)) if root[i] == x and rows[i][0] is not None), default=None) for x in root}
    path = str(tmp_path / "v")
    spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, label int, n_links long, component string").write.parquet(path)
    df = spark.read.parquet(path)
    got = embedding_links(df, block=7).collect()
    want = {i: (r[0], count[i], least[root[i]]) for i, r in enumerate(rows)}
    assert Counter((r.vec_id, r.n_links, r.component_id) for r in got) == Counter(want.values())
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got)
    assert embedding_links(df.limit(0)).collect() == []


def test_vector_recall(spark):
    """Links of the test table against all pairs."""
    from tidemart.llm.queries import QUERIES
    sf = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    x = np.stack([np.asarray(v, float) for v in rows["embedding"]])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = (x @ x.T >= 0.98) & (rows["label"].to_numpy()[:, None] == rows["label"].to_numpy()[None, :])
    np.fill_diagonal(near, False)
    found = QUERIES["op7_embedding_dedup"](spark, sf).toPandas().set_index("vec_id")["n_links"].loc[rows["vec_id"]].to_numpy()
    assert (found <= near.sum(axis=1)).all() and found.sum() >= 0.9 * near.sum()
