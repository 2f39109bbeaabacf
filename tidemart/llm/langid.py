"""Language identification from averaged hashed subword embeddings."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "und"
#: Bytes of text whose subwords are looked up at once.
CHUNK = 1 << 16
_ASCII_LETTER = re.compile(rb"[A-Za-z]")


@dataclass
class Model:
    """languages; table: each bucket's embedding times the softmax weights;
    bias; temperature: calibrates the scores; reject: calibrated score under
    which a prediction is rejected; lengths, bits: of the subword hash;
    noise_rejected: share of the calibration's noise under that score."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    reject: float
    lengths: tuple[int, ...]
    bits: int
    noise_rejected: float = 0.0


def buckets(text: np.ndarray, lengths: Sequence[int], bits: int) -> list[np.ndarray]:
    """Hash buckets of all byte n-grams of a text (uint8), by n-gram length."""
    out, t = [], text.astype(np.uint32)
    h = np.full(len(t), 0x811C9DC5, np.uint32)
    for n in range(1, min(max(lengths), len(t)) + 1):
        h = (h[:len(t) - n + 1] ^ t[n - 1:]) * np.uint32(0x01000193)  # FNV-1a
        if n in lengths:
            out.append(((h ^ (h >> np.uint32(15))) * np.uint32(0x9E3779B1)) >> np.uint32(32 - bits))
    return out


def logits(model: Model, text: bytes) -> np.ndarray:
    """Mean over the whole text's subwords, in chunks that overlap by the
    longest subword less one byte, so each subword counts once."""
    data = np.frombuffer(text.lower(), np.uint8)
    total, count, over = np.zeros(len(model.languages)), 0, max(model.lengths) - 1
    for at in range(0, len(data), CHUNK):
        own = min(CHUNK, len(data) - at)  # subwords that begin in the chunk
        for b in buckets(data[at:at + own + over], model.lengths, model.bits):
            b = b[:own]
            total += np.ones(len(b), np.float32) @ model.table.take(b, axis=0)
            count += len(b)
    return total / max(1, count) + model.bias


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def has_letter(text: bytes) -> bool:
    return bool(_ASCII_LETTER.search(text)) or any(c.isalpha() for c in text.decode("utf-8", "replace"))


def predict(model: Model, text: bytes | None) -> tuple[str, float]:
    """(language, calibrated score); (``und``, 0) without any letter."""
    if text is None or not has_letter(text):
        return UNKNOWN, 0.0
    p = softmax(logits(model, text) / model.temperature)
    k = int(p.argmax())
    return model.languages[k], float(p[k])


def train(texts: Sequence[str], labels: Sequence[str], dim: int = 16, bits: int = 16,
          lengths: tuple[int, ...] = (1, 2, 3, 4), epochs: int = 3, rate: float = 0.5, seed: int = 7) -> Model:
    """Fit embeddings and a linear softmax by stochastic gradient descent.

    A training example is a random window of a text, of 8 to 2,000 characters,
    so that short texts are learnt too.  Every fifth text is kept out of the
    descent and calibrates: the temperature with the least log loss, and the
    rejection score (see ``rejection``)."""
    rng = np.random.default_rng(seed)
    languages = sorted(set(labels))
    y = np.array([languages.index(x) for x in labels])
    model = Model(languages, np.zeros((1 << bits, len(languages)), np.float32), np.zeros(len(languages)), 1.0, 0.0, lengths, bits)
    if not languages:
        return model

    def example(text: str) -> tuple[np.ndarray, np.ndarray]:
        n = int(min(len(text), np.exp(rng.uniform(np.log(8), np.log(2000)))))
        at = int(rng.integers(0, len(text) - n + 1))
        b = buckets(np.frombuffer(text[at:at + n].encode().lower(), np.uint8), lengths, bits)
        return np.unique(np.concatenate(b), return_counts=True) if b else (np.empty(0, np.uint32),) * 2

    embed = np.zeros((1 << bits, dim))
    weights, bias = rng.normal(0, dim ** -0.5, (dim, len(languages))), np.zeros(len(languages))
    usable = np.array([bool(t) and has_letter(t.encode()) for t in texts], bool)
    fit = np.flatnonzero((np.arange(len(texts)) % 5 != 4) & usable)
    for epoch in range(epochs):
        for step, i in enumerate(rng.permutation(fit)):
            b, c = example(texts[i])
            if not len(b):
                continue
            share = c / c.sum()
            mean = share @ embed[b]
            g = softmax(mean @ weights + bias)
            g[y[i]] -= 1
            lr = rate * (1 - (epoch + step / len(fit)) / epochs)
            back = weights @ g
            weights -= lr * np.outer(mean, g)
            bias -= 0.01 * lr * g
            # Scaled so that the mean moves by lr, however long the text is.
            embed[b] -= lr * (share / (share @ share))[:, None] * back
    model.table, model.bias = (embed @ weights).astype(np.float32), bias
    held = [i for i in np.flatnonzero(usable) if i % 5 == 4]
    if held:
        raw = []
        for i in held:
            b, c = example(texts[i])
            raw.append((c / max(1, c.sum())) @ model.table[b] + bias if len(b) else bias)
        raw, want = np.array(raw), y[held]
        temperatures = np.geomspace(0.05, 20, 60)
        loss = [-np.log(softmax(raw / t)[np.arange(len(want)), want] + 1e-12).mean() for t in temperatures]
        model.temperature = float(temperatures[int(np.argmin(loss))])
        model.reject, model.noise_rejected = rejection(model, [texts[i] for i in held], [labels[i] for i in held], texts, rng)
    return model


def noise(text: str, letters: Sequence[str], rng: np.random.Generator) -> str:
    """``text`` with every letter replaced by a random one of ``letters``."""
    drawn = iter(rng.integers(0, len(letters), len(text)))
    return "".join(letters[k] if c.isalpha() else c for c, k in zip(text, drawn))


def rejection(model: Model, held: Sequence[str], labels: Sequence[str], texts: Sequence[str], rng: np.random.Generator) -> tuple[float, float]:
    """The score under which a prediction is rejected, from texts kept out of
    the descent and the same texts as noise: their letters drawn evenly from
    those of all texts, and from a script no text uses.

    It lies above 99 % of the noise, unless that takes over one in a thousand
    of the right predictions; then it leaves those alone.  Also the share of
    the noise that it rejects."""
    alphabet = sorted({c for t in texts for c in t if c.isalpha()})
    scripts = [[chr(c) for c in range(first, first + 32)] for first in (0x430, 0x561, 0x10D0, 0x3B1, 0x5D0)]
    foreign = next((s for s in scripts if not set(s) & set(alphabet)), scripts[0])
    told = [predict(model, t.encode()) for t in held]
    right = np.array([score for (name, score), want in zip(told, labels) if name == want])
    junk = np.array([predict(model, noise(t, own, rng).encode())[1] for t in held for own in (alphabet, foreign)])
    if not len(right):
        return 0.0, 0.0
    reject = float(min(np.quantile(junk, 0.99), np.quantile(right, 0.001)))
    return reject, float((junk < reject).mean())


def training_sample(df: DataFrame, text_col: str, label_col: str, train_rows: int, train_chars: int) -> pd.DataFrame:
    """At most about ``train_rows`` labelled texts for each language, of each a
    window of ``train_chars`` that may lie anywhere in it: a bounded sample,
    chosen by a hash of the text, so that reruns agree.  Only the fit is
    bounded; every prediction reads the whole text."""
    labelled = df.filter(F.col(label_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(label_col).alias("label"), F.col(text_col).alias("text"))
    draw = F.shiftrightunsigned(F.xxhash64("text"), 33) / float(1 << 31)
    sizes = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return pd.DataFrame({"label": [], "text": []})
    shares = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, train_rows / n)])
    at = (1 + F.pmod(F.xxhash64("text", F.lit("window")), F.greatest(F.length("text") - train_chars, F.lit(0)) + 1)).cast("int")
    return (labelled.filter(draw < F.element_at(shares, F.col("label")))
            .select("label", F.substring("text", at, F.lit(train_chars)).alias("text"))
            .dropDuplicates().toPandas().sort_values(["label", "text"], ignore_index=True))


def fit(df: DataFrame, text_col: str = "text", label_col: str = "lang",
        train_rows: int = 1000, train_chars: int = 4000, **settings) -> Model:
    """Train on a bounded sample of labelled rows.  The number of languages
    has to be small; the sample is ``train_rows`` texts of each.  Rows with a
    null text or label teach nothing, equal texts of one label count once, and
    an empty table gives a model that knows no language."""
    sample = training_sample(df, text_col, label_col, train_rows, train_chars)
    order = np.random.default_rng(1).permutation(len(sample))
    return train([sample["text"][i] for i in order], [sample["label"][i] for i in order], **settings)


def language(model: Model, df: DataFrame, text: Column) -> Column:
    """struct(lang, score) for every whole text, in Arrow batches.

    Null texts and texts without a letter are ``und`` with score 0; a model
    that learnt no language calls everything ``und``.  Equal scores take the
    first language in order.  A text's result depends on that text alone, so
    repeated rows get the same; other columns are never read."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # a table of fixed size

    @F.pandas_udf("lang string, score double")
    def run(texts: pd.Series) -> pd.DataFrame:
        m = shared.value
        out = [predict(m, t) if m.languages else (UNKNOWN, 0.0) for t in texts]
        return pd.DataFrame(out, columns=["lang", "score"])

    return run(text.cast("binary"))


def held_out(id_col: Column) -> Column:
    """The held-out fold: crc32 of the id as text, mod 4, is 2 (null id: no)."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))
