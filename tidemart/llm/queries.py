"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import langid
from .centroids import cluster
from .common import read_table
from .divergence import divergence
from .embed_dedup import embedding_links
from .exact_dedup import exact_dedup
from .html_extract import extract
from .license_scan import license_scan
from .line_dedup import line_dedup
from .mixing import mix
from .packing import pack
from .quality import quality
from .simhash import simhash_groups
from .suffix_dedup import suffix_dedup


#: Training texts for each language, and characters of each, at most about.
TRAIN_ROWS, TRAIN_CHARS = 1000, 4000


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    fold = langid.held_out(F.col("doc_id"))
    model = langid.fit(docs.filter(~fold & F.col("doc_id").isNotNull()), train_rows=TRAIN_ROWS, train_chars=TRAIN_CHARS)
    out = docs.select("doc_id", fold.alias("held_out"), langid.language(model, docs, F.col("text")).alias("p"))
    return out.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = read_table(spark, sf_dir, "pages").select("page_id", "url", extract(F.col("html")).alias("text"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(read_table(spark, sf_dir, "documents"), min_dice=0.8)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup(read_table(spark, sf_dir, "documents"), width=200)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_links(read_table(spark, sf_dir, "embeddings"), min_cos=0.98)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read_table(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its lines, the deleted ones, maximal deleted runs and a
    digest of what is left (null text: none)."""
    out = line_dedup(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_deleted", F.size("runs").cast("long").alias("n_runs"),
                      F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix(read_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return out.select(F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target",
                      (F.col("size") * F.col("copies")).alias("taken"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash_groups(read_table(spark, sf_dir, "documents"), shingle=3, max_bits=3)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(read_table(spark, sf_dir, "documents"), min_docs=30, top=50)


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, centroids = cluster(read_table(spark, sf_dir, "embeddings"), dim=64, count=16, rounds=3, scale=64)
    sums = {r.cluster: r.inertia for r in out.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}  # a row a cluster
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids] or [""]
    of = lambda values: F.get(F.array(*[F.lit(v) for v in values]), F.col("cluster"))
    return out.select("vec_id", "cluster", "distance", of([sums.get(k, 0) for k in range(len(names))]).cast("long").alias("cluster_inertia"),
                      F.lit(sum(sums.values())).cast("long").alias("inertia"), of(names).alias("centroid_sha256"))


#: The features that the contract of ``op13_quality`` returns.
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality(read_table(spark, sf_dir, "documents").select("doc_id", "text"), measures=BASE)
    m = F.col("m")
    base = (m["n_words"] < 50) | (100 * m["n_repeat_words"] > 50 * m["n_words"])
    return out.select(F.col("row.doc_id").alias("doc_id"), *[m[c].alias(c) for c in BASE], base.alias("base_failed"),
                      (~base & F.col("kept")).alias("kept"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_packing, op2_html_text, op3_language_id, op4_license_scan, op6_suffix_dedup, op7_embedding_dedup, op5_exact_dedup, op8_line_dedup, op9_mixing, op10_simhash, op11_source_divergence, op12_centroids, op13_quality)}

def _centroid_sql(rounds: int) -> str:
    """The rounds one after the other; all distances are worked out anew."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (
  SELECT rid, min(row(d, k)) AS best FROM (
    SELECT rid, k, list_sum([(v[i] - c[i]) * (v[i] - c[i]) for i in range(1, 65)])::BIGINT AS d FROM e, c{r}) GROUP BY rid)""")
        if r < rounds:
            steps.append(f"""
s{r} AS (SELECT k, i, sum(x) AS s, count(*) AS n
         FROM (SELECT best[2] AS k, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{r} JOIN e USING (rid)) GROUP BY k, i),
m{r} AS (SELECT k, list(((s - ((s % n + n) % n)) // n)::BIGINT ORDER BY i) AS c FROM s{r} GROUP BY k),
c{r + 1} AS MATERIALIZED (SELECT k, coalesce(m{r}.c, c{r}.c) AS c FROM c{r} LEFT JOIN m{r} USING (k))""")
    return f"""
WITH e AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, [floor(64.0::DOUBLE * x::DOUBLE)::BIGINT for x in embedding] AS v FROM embeddings
  WHERE len(embedding) = 64 AND len([1 for x in embedding if x IS NULL OR isnan(x) OR isinf(x)]) = 0),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS k, v AS c
  FROM (SELECT sha256('1:' || coalesce(vec_id::VARCHAR, '')) AS h, v FROM e ORDER BY h, v LIMIT 16)),{",".join(steps)}
SELECT vec_id, best[2]::INT AS cluster, best[1] AS distance, sum(best[1]) OVER (PARTITION BY best[2])::BIGINT AS cluster_inertia,
       sum(best[1]) OVER ()::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN e USING (rid) JOIN c{rounds} ON k = best[2]
"""


ORACLE_SQL = {
    "op5_exact_dedup": r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS bare FROM documents)
SELECT doc_id, keep_id, count(*) OVER (PARTITION BY bare) AS group_size, doc_id = keep_id AS kept,
       sha256(bare) AS text_sha256
FROM (SELECT *, first_value(doc_id) OVER (PARTITION BY bare ORDER BY n DESC, doc_id) AS keep_id FROM d)
""",
    # Sources fill up in the order of cap per weight; the rest share by weight.
    "op9_mixing": r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
             [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w
      FROM d GROUP BY source),
c AS (SELECT *, 2.0::DOUBLE * source_size AS cap, 1.5::DOUBLE * sum(source_size) OVER () AS budget FROM s),
f AS (SELECT *, (budget - coalesce(sum(cap) OVER before, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER before, 0)) AS lev
      FROM c WINDOW before AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT arg_min(lev, cap / w) AS lev FROM f WHERE lev * w <= cap),
t AS (SELECT source, source_size, CASE WHEN l.lev IS NULL THEN cap ELSE least(l.lev * w, cap) END AS target FROM f, l)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (size * (floor(target / greatest(source_size, 1)) + (('0x' || md5('mix:' || coalesce(doc_id::VARCHAR, ''))[1:12])::BIGINT / 281474976710656.0::DOUBLE
                < target / greatest(source_size, 1) - floor(target / greatest(source_size, 1)))::INT))::BIGINT AS taken
FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
""",
    # The shortest runs of 10 words or more that begin or end with each line;
    # a run seen before is deleted.
    "op8_line_dedup": r"""
WITH parts AS (SELECT doc_id, string_split(text, chr(10)) AS parts, text FROM documents),
l AS (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) - 1 AS idx FROM parts),
w AS (SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words FROM l),
q AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY idx) AS seq FROM w WHERE words > 0),
c AS (SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY seq) AS upto FROM q),
r AS (SELECT a.doc_id, a.seq AS start, min(b.seq) AS stop FROM c a JOIN c b ON a.doc_id = b.doc_id
             AND b.seq BETWEEN a.seq AND a.seq + 9 AND b.upto - a.upto + a.words >= 10 GROUP BY a.doc_id, a.seq
      UNION
      SELECT b.doc_id, max(a.seq), b.seq FROM c a JOIN c b ON a.doc_id = b.doc_id
             AND a.seq BETWEEN b.seq - 9 AND b.seq AND b.upto - a.upto + a.words >= 10 GROUP BY b.doc_id, b.seq),
k AS (SELECT r.*, string_agg(line, chr(10) ORDER BY seq) AS run
      FROM r JOIN c ON c.doc_id = r.doc_id AND c.seq BETWEEN start AND stop GROUP BY r.doc_id, start, stop),
g AS (SELECT doc_id, unnest(range(start, stop + 1)) AS seq
      FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, start) AS nth FROM k) WHERE nth > 1),
x AS (SELECT doc_id, seq, idx, seq - row_number() OVER (PARTITION BY doc_id ORDER BY seq) AS island
      FROM (SELECT DISTINCT * FROM g) JOIN c USING (doc_id, seq)),
i AS (SELECT doc_id, min(idx) AS first, max(idx) AS last FROM x GROUP BY doc_id, island),
n AS (SELECT doc_id, count(*) AS n_runs, list(first) AS firsts, list(last) AS lasts FROM i GROUP BY doc_id),
o AS (SELECT p.doc_id, p.parts, p.text, n.n_runs,
             [z for z, j in p.parts if len([1 for y in range(len(n.firsts)) if (j - 1) BETWEEN n.firsts[y + 1] AND n.lasts[y + 1]]) = 0] AS kept
      FROM parts p LEFT JOIN n USING (doc_id))
SELECT doc_id, coalesce(len(parts), 0)::BIGINT AS n_lines,
       CASE WHEN n_runs IS NULL THEN 0 ELSE len(parts) - len(kept) END::BIGINT AS n_deleted,
       coalesce(n_runs, 0)::BIGINT AS n_runs,
       sha256(CASE WHEN n_runs IS NULL THEN coalesce(text, '') ELSE coalesce(array_to_string(kept, chr(10)), '') END) AS kept_sha256
FROM o
""",
    # Every window of 200 bytes, by the digest of its hex text.
    "op6_suffix_dedup": r"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
p AS (SELECT rid, h, unnest(range(0, len(h) // 2 - 199)) AS place FROM d),
k AS MATERIALIZED (SELECT rid, place, md5_number(substring(h, 2 * place + 1, 400)) AS k FROM p),
t AS (SELECT rid, place FROM k WHERE k IN (SELECT k FROM k GROUP BY k HAVING count(*) > 1)),
g AS (SELECT rid, place, CASE WHEN place - lag(place) OVER (PARTITION BY rid ORDER BY place) > 200 THEN 1 ELSE 0 END AS jump FROM t),
i AS (SELECT rid, place, sum(jump) OVER (PARTITION BY rid ORDER BY place) AS nth FROM g),
s AS (SELECT rid, min(place) AS first, max(place) + 200 AS stop FROM i GROUP BY rid, nth),
r AS (SELECT rid, count(*) AS n, sum(stop - first)::BIGINT AS gone, list(first ORDER BY first) AS firsts, list(stop ORDER BY first) AS stops FROM s GROUP BY rid)
SELECT doc_id, len(h) // 2 AS n_bytes, coalesce(gone, 0) AS n_removed, coalesce(n, 0) AS n_spans,
       sha256(unhex(CASE WHEN n IS NULL THEN h ELSE array_to_string(
         [substring(h, 2 * z[1] + 1, 2 * (z[2] - z[1])) for z in list_zip(list_concat([0::BIGINT], stops), list_append(firsts, len(h) // 2))], '') END)) AS kept_sha256
FROM d LEFT JOIN r USING (rid)
""",
    # All pairs, then every vector that a walk over the links reaches.
    "op7_embedding_dedup": r"""
WITH RECURSIVE e AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
u AS MATERIALIZED (SELECT * FROM e WHERE label IS NOT NULL AND len([1 for x in v if x IS NULL OR isnan(x) OR isinf(x)]) = 0 AND len([1 for x in v if x <> 0]) > 0),
l AS MATERIALIZED (SELECT a.rid AS a, b.rid AS b FROM u a JOIN u b ON a.label = b.label AND len(a.v) = len(b.v) AND a.rid <> b.rid
                   WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
w AS (SELECT rid, rid AS other FROM e UNION SELECT w.rid, l.b FROM w JOIN l ON w.other = l.a),
c AS (SELECT w.rid, min(e.vec_id) AS component_id FROM w JOIN e ON e.rid = w.other GROUP BY w.rid),
n AS (SELECT a AS rid, count(*) AS n_links FROM l GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, coalesce(vec_id = component_id, false) AS kept
FROM e JOIN c USING (rid) LEFT JOIN n USING (rid)
""",
    # Words in windows of three, and how often their text has each window.
    "op13_quality": r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
             [x for x in string_split(text, chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines FROM d),
p AS (SELECT rid, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM w),
r AS (SELECT rid, place, list_value(word, lead(word, 1) OVER doc, lead(word, 2) OVER doc) AS run, lead(place, 2) OVER doc AS stop
      FROM p WINDOW doc AS (PARTITION BY rid ORDER BY place)),
n AS (SELECT rid, place, count(*) OVER (PARTITION BY rid, run) AS times FROM r WHERE stop IS NOT NULL),
c AS (SELECT rid, count(DISTINCT word_place) AS n_repeat_words
      FROM (SELECT rid, unnest([place, place + 1, place + 2]) AS word_place FROM n WHERE times > 1) GROUP BY rid),
f AS (SELECT doc_id, len(words)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
             len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
             (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
             len(lines) AS n_lines, len(regexp_extract_all(text, '[A-Z]')) AS n_upper, len(regexp_extract_all(text, '[a-z]')) AS n_lower
      FROM w LEFT JOIN c USING (rid)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (10 * n_symbols > n_words OR n_upper > n_lower OR word_chars NOT BETWEEN 2 * n_words AND 15 * n_words
                                OR 2 * n_dup_lines > n_lines) AS kept
FROM b
""",
    "op12_centroids": _centroid_sql(3),
    # Every group beside every kept term of its language.
    "op11_source_divergence": r"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
o AS (SELECT rid, lang, source, unnest(terms) AS term FROM d),
k AS (SELECT lang, term FROM o GROUP BY lang, term HAVING count(DISTINCT rid) >= 30),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM o SEMI JOIN k USING (lang, term) GROUP BY lang, source, term),
x AS (SELECT lang, source, term, coalesce(n, 0) AS n FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
y AS (SELECT *, sum(n) OVER own AS total, count(*) OVER own AS v, sum(n) OVER (PARTITION BY lang, term) AS lang_n FROM x
      WINDOW own AS (PARTITION BY lang, source)),
t AS (SELECT lang, sum(n) AS lang_total FROM c GROUP BY lang),
p AS (SELECT lang, source, term, n, (1 + 1000000000::HUGEINT * (n + 5)::HUGEINT // (total + 5 * v)::HUGEINT)::BIGINT AS p,
             (1 + 1000000000::HUGEINT * (lang_n + 5)::HUGEINT // (lang_total + 5 * v)::HUGEINT)::BIGINT AS q FROM y JOIN t USING (lang)),
f AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p))::BIGINT AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
      UNION ALL
      SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank
FROM r QUALIFY part = 'pair' OR rank <= 50
""",
}
