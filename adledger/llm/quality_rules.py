"""Quality rules as a learned decision list, in DataFrame functions only.

Statistics of every text are computed inside its row. From labelled rows, sequential covering learns an ordered list of
rules, each a conjunction of thresholds on statistics that marks bad texts: a rule is grown literal by literal on one
part of the labelled rows, cut back on the other, and what it covers is taken out before the next. Growing needs only
counts by statistic, bin and label, so its jobs return a few hundred rows whatever the size of the table. The list is
emitted as one conditional expression.

Defined cases: a null text is empty and has no words; a text without words fails the base rule. Null ids never match a
label. A label of null is no label, and an id with two different labels is left out. Without labels of both kinds there
are no rules, and the base rule alone decides. Repeated rows are judged alike. Other columns pass through untouched.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import pairwise
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adledger.llm.rows import whole_text
from adledger.session import saved

#: ASCII white space, the symbols that count, and the base rule's limits.
SPACE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED = 0.5

#: What rules may test, as expressions over the statistics.
FEATURES = {
    "word_length": lambda s: s["word_chars"] / F.greatest(s["n_words"], F.lit(1)),
    "symbol_share": lambda s: s["n_symbols"] / F.greatest(s["word_chars"], F.lit(1)),
    "capital_share": lambda s: s["n_capitals"] / F.greatest(s["word_chars"], F.lit(1)),
    "digit_share": lambda s: s["n_digits"] / F.greatest(s["word_chars"], F.lit(1)),
    "mark_share": lambda s: s["n_marks"] / F.greatest(s["n_words"], F.lit(1)),
    "repeat_share": lambda s: s["n_repeat_words"] / F.greatest(s["n_words"], F.lit(1)),
    "repeat_line_share": lambda s: s["n_dup_lines"] / F.greatest(s["n_lines"], F.lit(1)),
    "distinct_share": lambda s: s["n_distinct_words"] / F.greatest(s["n_words"], F.lit(1)),
}


def bind(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed once.

    A generator of one row stands between what makes a column and what uses it, so the optimizer does not copy the
    expression into each use, which inside a lambda would mean once per element.
    """
    return df.select("*", F.inline(F.array(F.struct(*(c.alias(n) for n, c in columns.items())))))


def _let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def _repeated_words(hashes: Column) -> Column:
    """Words in windows whose hash occurs twice or more, given the hashes of all three-word windows in order."""

    def spread(at: Column) -> Column:
        steps = F.transform(at, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - x, F.lit(3))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    def repeats(s: Column) -> Column:
        twice = lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"])
        return _let(F.sort_array(F.transform(F.filter(s, twice), lambda x: x["i"])), spread)

    in_order = F.sort_array(F.transform(hashes, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(_let(in_order, repeats))


def with_statistics(docs: DataFrame, text_col: str = "text", name: str = "_quality") -> DataFrame:
    """``docs`` with a struct of statistics: counts over the whole text of each row."""
    before = docs.columns
    df = bind(docs, _q_text=whole_text(docs, text_col))
    text = F.col("_q_text")
    body = F.btrim(text, F.lit(SPACE))
    of = lambda marks: F.length(F.regexp_replace(text, f"[^{marks}]+", ""))
    df = bind(
        df,
        _q_words=F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, r"[\x20\x09-\x0D]+")),
        _q_lines=F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != ""),
        _q_symbols=of(SYMBOLS), _q_capitals=of(r"\p{Lu}"), _q_digits=of("0-9"), _q_marks=of("!?"),
    )
    words = F.col("_q_words")
    df = bind(df, _q_hashes=F.transform(words, lambda w: F.xxhash64(w)))
    singles = F.col("_q_hashes")
    windows = F.transform(F.slice(singles, 3, F.greatest(F.size(singles), F.lit(1))), lambda x, i: F.xxhash64(F.get(singles, i), F.get(singles, i + 1), x))
    df = bind(df, _q_windows=windows)
    long = lambda c: c.cast("long")
    stats = F.struct(
        long(F.size(words)).alias("n_words"), long(F.length(F.array_join(words, ""))).alias("word_chars"),
        long(F.col("_q_symbols")).alias("n_symbols"), long(F.col("_q_capitals")).alias("n_capitals"),
        long(F.col("_q_digits")).alias("n_digits"), long(F.col("_q_marks")).alias("n_marks"),
        long(F.size("_q_lines")).alias("n_lines"), long(F.size("_q_lines") - F.size(F.array_distinct("_q_lines"))).alias("n_dup_lines"),
        long(F.size(F.array_distinct(singles))).alias("n_distinct_words"), long(_repeated_words(F.col("_q_windows"))).alias("n_repeat_words"),
    )
    return bind(df, **{name: stats}).select(*(F.col(f"`{c}`") for c in before), name)


def base_failed(s: Column) -> Column:
    return (s["n_words"] < LEAST_WORDS) | (100 * s["n_repeat_words"] > int(100 * MOST_REPEATED) * s["n_words"])


@dataclass(frozen=True)
class Literal:
    feature: str
    above: bool
    threshold: float

    def test(self, stats: Column) -> Column:
        value = FEATURES[self.feature](stats)
        return value > F.lit(self.threshold) if self.above else value <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Literal, ...]


def _holds(rule: Rule, binned: dict[tuple[str, float], int]) -> Column:
    tests = [F.col(x.feature) >= binned[x.feature, x.threshold] if x.above else F.col(x.feature) < binned[x.feature, x.threshold] for x in rule]
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def _gain(p: int, n: int, p0: int, n0: int) -> float:
    """FOIL's gain of covering p bad and n good rows in place of p0 and n0."""
    return p * (log2(p / (p + n)) - log2(p0 / (p0 + n0))) if p else 0.0


def learn_rules(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    sample_rows: int = 20_000, most_rules: int = 8, most_literals: int = 4, least_precision: float = 0.97, least_cover: int = 5,
) -> list[Rule]:
    """An ordered list of rules for bad texts (label 0), learned from at most ``sample_rows`` labelled rows.

    The sample is the labels whose id has the least hash, so it is the same in each run. It is broadcast: its size is
    bounded by the parameter. Rows that the base rule rejects are not learned from.
    """
    told = labels.filter(labels[label_col].isNotNull() & labels[id_col].isNotNull()).groupBy(labels[id_col].cast("long").alias("_l_id"))
    told = told.agg(F.min(label_col).alias("_l_good"), F.max(label_col).alias("_l_most")).filter("_l_good = _l_most").drop("_l_most")
    told = saved(told.orderBy(F.xxhash64("_l_id"), "_l_id").limit(sample_rows), "labels")
    picked = docs.select(docs[id_col].cast("long").alias("_l_id"), docs[text_col].alias("_l_text")).join(F.broadcast(told), "_l_id")
    stats = with_statistics(picked, "_l_text")
    s = F.col("_quality")
    values = saved(
        stats.filter(~base_failed(s)).select("_l_good", (F.pmod(F.xxhash64("_l_id", F.lit(7)), F.lit(3)) == 0).alias("prune"), *(f(s).alias(n) for n, f in FEATURES.items())),
        "labelled-statistics",
    )
    shares = [0.0, 0.01, *(k / 40 for k in range(1, 40)), 0.99, 1.0]
    cuts = values.groupBy("_l_good").agg(*(F.percentile_approx(n, shares, 1000).alias(n) for n in FEATURES)).collect()
    if {bool(r["_l_good"]) for r in cuts} != {True, False}:
        return []
    seen = {n: sorted({float(v) for r in cuts for v in r[n]}) for n in FEATURES}
    thresholds = {n: [(a + b) / 2 for a, b in pairwise(v)] for n, v in seen.items()}
    binned = {(n, t): k + 1 for n, ts in thresholds.items() for k, t in enumerate(ts)}
    below = lambda n: F.size(F.filter(F.array(*map(F.lit, thresholds[n])), lambda t: t < F.col(n)))
    rows = saved(values.select((F.col("_l_good") == 0).alias("bad"), "prune", *(below(n).alias(n) for n in FEATURES)), "binned-statistics")
    growing, pruning, rules = rows.filter(~F.col("prune")), rows.filter("prune"), []
    cells = F.explode(F.array(*(F.struct(F.lit(n).alias("f"), F.col(n).alias("b")) for n in FEATURES))).alias("c")

    def grow() -> Rule:
        rule: Rule = ()
        while len(rule) < most_literals:
            counts = growing.filter(_holds(rule, binned)).select("bad", cells).groupBy("c.f", "c.b").agg(F.sum(F.col("bad").cast("long")).alias("p"), F.count("*").alias("n")).collect()
            by = {n: {} for n in FEATURES}
            for r in counts:
                by[r["f"]][r["b"]] = (r["p"], r["n"] - r["p"])
            p0, n0 = (sum(x[k] for x in by["word_length"].values()) for k in (0, 1))
            if not p0 or not n0:
                break
            best = (0.0, None)
            for name, cell in by.items():
                p, n = 0, 0
                for k, t in enumerate(thresholds[name]):
                    p, n = p + cell.get(k, (0, 0))[0], n + cell.get(k, (0, 0))[1]
                    best = max(best, (_gain(p, n, p0, n0), Literal(name, False, t)), (_gain(p0 - p, n0 - n, p0, n0), Literal(name, True, t)), key=lambda x: x[0])
            if best[1] is None or best[0] < 1e-9:
                break
            rule = (*rule, best[1])
        return rule

    while len(rules) < most_rules:
        rule = grow()
        if not rule:
            break
        prefixes = [rule[:k] for k in range(1, len(rule) + 1)]
        sums = [f(F.when(_holds(x, binned), y)) for x in prefixes for f, y in ((F.sum, F.col("bad").cast("long")), (F.count, F.lit(1)))]
        row = pruning.agg(*(F.coalesce(c, F.lit(0)).alias(f"c{k}") for k, c in enumerate(sums))).first()
        scored = [((2 * row[2 * k] - row[2 * k + 1]) / max(row[2 * k + 1], 1), row[2 * k], row[2 * k + 1], x) for k, x in enumerate(prefixes)]
        _, p, n, rule = max(scored, key=lambda x: x[0])
        if p < least_cover or p < least_precision * n:
            break
        rules.append(rule)
        growing, pruning = (x.filter(~_holds(rule, binned)) for x in (growing, pruning))
    return rules


def verdict(rules: list[Rule], stats: Column) -> Column:
    """The decision list as one expression: the first rule that holds rejects, else the text is kept."""
    tests = [reduce(lambda a, b: a & b, (x.test(stats) for x in rule)) for rule in rules]
    return reduce(lambda rest, t: F.when(t, False).otherwise(rest), reversed(tests), F.lit(True))


def judged(docs: DataFrame, rules: list[Rule], text_col: str = "text", name: str = "_quality") -> DataFrame:
    """``docs`` with the struct of statistics, ``base_failed`` and ``kept`` under ``name``."""
    df, s = with_statistics(docs, text_col, name), F.col(name)
    failed = base_failed(s)
    return df.withColumn(name, s.withField("base_failed", failed).withField("kept", ~failed & verdict(rules, s)))
