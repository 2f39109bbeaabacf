"""Quality rules as a short-circuit cascade, in native expressions."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, stored, without_spaces

#: A word of the contract: a run of characters other than space and TAB .. CR.
WORD = r"[^\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeat_words(text: Column, window: int = 3, hash_bits: int = 40) -> Column:
    """Words that lie in a run of ``window`` words found twice or more.

    Every run is one number, ``hash_bits`` of its hash above its place, so a
    plain sort brings equal runs together; the places of those that have an
    equal neighbour are counted once where they overlap.  Where neighbours of
    one hash differ in words, or places need more bits, the text's runs are
    sorted by their words instead, so the count is exact for every text."""
    place_bits = 64 - hash_bits
    mask = (1 << place_bits) - 1

    def places(words: Column) -> Column:
        return F.sequence(F.lit(0).cast("long"), F.size(words).cast("long") - window)

    def word(words: Column, i: Column, k: int) -> Column:
        return F.get(words, (i + k).cast("int"))

    def numbers(words: Column) -> Column:
        return F.sort_array(F.transform(places(words), lambda i: F.shiftleft(
            F.xxhash64(*[word(words, i, k) for k in range(window)]), place_bits).bitwiseOR(i)))

    def beside(s: Column, i: Column, key: Callable[[Column], Column]) -> Column:
        """Whether element i of a sorted array has an equal neighbour."""
        own = key(F.get(s, i))
        return (own == key(F.get(s, i - 1))) | (own == key(F.get(s, i + 1)))

    def covered(at: Column) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-window).cast("long").alias("last"))
        return F.aggregate(F.sort_array(at), start, lambda a, p: F.struct(
            (a["n"] + F.least(F.lit(window), p - a["last"])).alias("n"), p.alias("last")), lambda a: a["n"])

    def by_hash(words: Column, again: Column) -> Column:
        """From the numbers with a neighbour of equal hash; null on a clash."""
        def clash(x: Column, i: Column) -> Column:
            y = F.get(again, i - 1)
            here, there = x.bitwiseAND(F.lit(mask)), y.bitwiseAND(F.lit(mask))
            differ = word(words, here, 0) != word(words, there, 0)
            for k in range(1, window):
                differ = differ | (word(words, here, k) != word(words, there, k))
            return (F.shiftright(x, place_bits) == F.shiftright(y, place_bits)) & differ
        return F.when(F.size(F.filter(again, clash)) == 0, covered(F.transform(again, lambda x: x.bitwiseAND(F.lit(mask)))))

    def by_words(words: Column) -> Column:
        runs = F.sort_array(F.transform(places(words), lambda i: F.struct(
            F.struct(*[word(words, i, k).alias(f"w{k}") for k in range(window)]).alias("key"), i.alias("at"))))
        return let(runs, lambda s: covered(F.transform(F.filter(s, lambda x, i: beside(s, i, lambda y: y["key"])), lambda x: x["at"])))

    def count(words: Column) -> Column:
        quick = let(numbers(words), lambda s: let(
            F.filter(s, lambda x, i: beside(s, i, lambda y: F.shiftright(y, place_bits))), lambda again: by_hash(words, again)))
        return (F.when(F.size(words) <= window, F.lit(0).cast("long"))
                .when(F.size(words) > mask, by_words(words)).otherwise(F.coalesce(quick, by_words(words))))

    return let(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), count)


def dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line of the text."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.btrim(x, F.lit(SPACES))) > 0)
    return let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def _count(pattern: str) -> Callable[[Column], Column]:
    return lambda text: F.regexp_count(text, F.lit(pattern)).cast("long")


#: What rules are made of: functions of a text that isn't null.
FEATURES: dict[str, Callable[[Column], Column]] = {
    "n_words": _count(WORD),
    "word_chars": lambda t: F.length(without_spaces(t)).cast("long"),
    "n_symbols": _count(r"[#*$%&|<>]"),
    "n_dup_lines": dup_lines,
    "n_repeat_words": repeat_words,
    "n_lines": lambda t: F.size(F.filter(F.split(t, "\n"), lambda x: F.length(F.btrim(x, F.lit(SPACES))) > 0)).cast("long"),
    "n_upper": _count(r"[A-Z]"),
    "n_lower": _count(r"[a-z]"),
}


@dataclass(frozen=True)
class Rule:
    """``fails`` gets a function that gives a feature by its name."""

    name: str
    fails: Callable[[Callable[[str], Column]], Column]


#: The production rules: too short or too repetitive (the base of the
#: contract), laid out with symbols, shouted, of odd words, of copied lines.
RULES = (
    Rule("short", lambda f: f("n_words") < 50),
    Rule("repetitive", lambda f: 100 * f("n_repeat_words") > 50 * f("n_words")),
    Rule("symbols", lambda f: 10 * f("n_symbols") > f("n_words")),
    Rule("capitals", lambda f: f("n_upper") > f("n_lower")),
    Rule("word_length", lambda f: ~f("word_chars").between(2 * f("n_words"), 15 * f("n_words"))),
    Rule("dup_lines", lambda f: 2 * f("n_dup_lines") > f("n_lines")),
)


def order_rules(outcomes: Mapping[tuple[bool, ...], int], seconds: Sequence[float]) -> list[int]:
    """The order that rejects most for its cost: from the sample's outcomes
    (which rules a row fails -> rows) each next rule is the one that rejects
    most of the rows still left, per second.  Ties and rules that reject
    nothing: the cheaper first, then the earlier."""
    left, order = dict(outcomes), []
    while len(order) < len(seconds):
        def gain(k: int) -> tuple:
            return (-sum(n for fails, n in left.items() if fails[k]) / seconds[k], seconds[k], k)
        best = min((k for k in range(len(seconds)) if k not in order), key=gain)
        order.append(best)
        left = {fails: n for fails, n in left.items() if not fails[best]}
    return order


def estimate(sample: DataFrame, rules: Sequence[Rule], measured: Sequence[str]) -> list[int]:
    """The cascade's order from a small table (text, m): every rule is timed
    by itself on the whole sample, less the time of a rule-free pass, and all
    outcomes are counted together."""
    feature = _features(measured)

    def seconds(what: Column) -> float:
        spent = []
        for _ in range(2):  # the first run compiles
            begin = time.perf_counter()
            sample.agg(F.count_if(what)).collect()
            spent.append(time.perf_counter() - begin)
        return min(spent)

    idle = seconds(F.length("text") < 0)
    cost = [max(seconds(r.fails(feature)) - idle, 1e-3) for r in rules]
    fails = [F.coalesce(r.fails(feature), F.lit(False)).alias(f"r{k}") for k, r in enumerate(rules)]
    rows = sample.select(*fails).groupBy(*[f"r{k}" for k in range(len(rules))]).count().collect()
    return order_rules({tuple(r[:-1]): r[-1] for r in rows}, cost)


def _features(measured: Sequence[str]) -> Callable[[str], Column]:
    return lambda name: F.col("m")[name] if name in measured else FEATURES[name](F.col("text"))


def quality(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Sequence[Rule] = RULES,
            measures: Sequence[str] = (), order: Sequence[str] | None = None, sample_rows: int = 2000) -> DataFrame:
    """Put every text through a cascade of rules that stops at the first one
    it fails.

    Unless ``order`` names the rules in order, their cost and what they
    reject are estimated on about ``sample_rows`` rows, picked by the hash of
    the id, and the rules run by rejection per cost: what is cheap and
    rejects much comes first, and a dear feature is worked out only for texts
    that passed all before it.  The order changes which rule a text is said
    to fail, never whether it is kept.  ``measures`` are features worked out
    for every row because the caller wants them; rules use these for nothing.

    One pass without a shuffle, all in native expressions; the memory of a
    task follows its longest text.

    Returns every input row as ``row`` (a struct of the input columns), a
    struct ``m`` of the measures, ``failed`` (the rule that rejected it, or
    null) and ``kept``.  Null texts count as empty and fail ``short``; rows
    with equal ids, copies and repeated rows are judged each by itself; an
    empty table gives no rows."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    flat = df.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), text.alias("text"))
    with_measures = F.struct(*[FEATURES[m](F.col("text")).alias(m) for m in measures]) if measures else F.struct(F.lit(True).alias("none"))
    if order is None:
        n = df.count()
        share = min(1.0, sample_rows / n) if n else 1.0
        draw = F.shiftrightunsigned(F.xxhash64("id"), 33) / float(1 << 31)
        picked = flat.filter(draw < share).select("text").limit(2 * sample_rows)
        sample = stored(picked.select("text", with_measures.alias("m")), "quality-sample")
        ranked = [rules[k] for k in estimate(sample, rules, measures)]
    else:
        by_name = {r.name: r for r in rules}
        ranked = [by_name[name] for name in order]
    feature, verdict = _features(measures), F.lit(None).cast("string")
    for rule in reversed(ranked):
        verdict = F.when(rule.fails(feature), F.lit(rule.name)).otherwise(verdict)
    return (flat.select("row", "text", with_measures.alias("m")).select("row", "m", verdict.alias("failed"))
            .withColumn("kept", F.col("failed").isNull()))
