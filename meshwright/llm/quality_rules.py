"""Quality rules: an ordered decision list, learned from labelled text statistics.

``text_statistics`` measures each whole text with column expressions.
``learn_rules`` covers the rejected class rule by rule: a rule grows threshold
by threshold while it gains information on two thirds of the labelled rows, is
pruned on the other third, and stays if it is precise there; the rows it covers
leave and the next rule starts. Thresholds are quantiles of all labelled rows.
The driver sees counts per (statistic, bin), never rows. ``verdict`` turns the
list into one conditional expression.

Cases: a null or empty text has no words (and fails the base rule); without
labels, or with one class only, the list is empty and the base rule decides;
a null label is ignored; repeated rows count as often as they occur.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshwright.llm.common import let, restored, set_aside, space_words, total, whole_text
from meshwright.session import cut

WINDOW = 8
BASE_COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE_COLUMNS = ["n_lines", "n_distinct_words", "n_upper", "n_exclamations", "n_bars"]
# Statistics a rule may test, as expressions over the counts above.
FEATURES = {
    "n_words": "n_words", "word_length": "word_chars / n_words", "symbol_rate": "n_symbols / n_words",
    "dup_line_rate": "n_dup_lines / n_lines", "repeat_rate": "n_repeat_words / n_words",
    "distinct_rate": "n_distinct_words / n_words", "upper_rate": "n_upper / word_chars",
    "exclamation_rate": "n_exclamations / n_words", "bar_rate": "n_bars / n_words", "line_words": "n_words / n_lines",
}


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: float

    def column(self) -> Column:
        value = F.coalesce(F.col(f"f_{self.feature}"), F.lit(0.0))
        return value >= F.lit(self.threshold) if self.at_least else value < F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<'} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def repeated_words(words: Column, width: int = WINDOW) -> Column:
    """Words inside a window of ``width`` words that occurs twice or more in the same text.

    Windows are compared by 64-bit hashes. Only texts with a repeated window
    sort their windows.
    """
    hashes = let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: F.transform(
        F.sequence(F.lit(0), F.size(h) - width), lambda i: F.xxhash64(F.slice(h, i + 1, width))))

    def covered(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
        starts = let(ordered, lambda s: F.sort_array(F.transform(
            F.filter(s, lambda e, k: e["x"].eqNullSafe(F.get(s, k - 1)["x"]) | e["x"].eqNullSafe(F.get(s, k + 1)["x"])),
            lambda e: e["i"])))
        return let(starts, lambda p: total(F.transform(
            p, lambda v, k: F.least(F.lit(width), F.coalesce(F.get(p, k + 1) - v, F.lit(width))).cast("bigint"))))

    repeats = let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("bigint")).otherwise(covered(h)))
    return F.when(F.size(words) > width, repeats).otherwise(F.lit(0).cast("bigint"))


def text_statistics(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns of ``docs`` with the counts above and the features (``f_…``)."""
    keep = docs.columns if keep is None else keep
    rows, inner = set_aside(docs, ())
    own = inner[text]
    inner = {c: inner[c] for c in keep if c.lower() not in {*BASE_COLUMNS, *MORE_COLUMNS, *(f"f_{f}" for f in FEATURES)}}
    kept = list(inner.values())
    body = whole_text(own)
    count = lambda pattern: F.regexp_count(body, F.lit(pattern)).cast("bigint")
    first = rows.select(
        *kept, space_words(body).alias("__words"), F.split(body, "\n").alias("__lines"),
        count(r"[#*$%&|<>]").alias("n_symbols"), count("[A-Z]").alias("n_upper"), count("!").alias("n_exclamations"),
        count(r"\|").alias("n_bars"))
    lines = F.filter("__lines", lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    words = F.col("__words")
    counts = first.select(
        *kept, F.size(words).cast("bigint").alias("n_words"),
        F.char_length(F.array_join(words, "")).cast("bigint").alias("word_chars"), "n_symbols",
        let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("bigint")).alias("n_dup_lines"),
        repeated_words(words).alias("n_repeat_words"), F.size("__lines").cast("bigint").alias("n_lines"),
        F.size(F.array_distinct(words)).cast("bigint").alias("n_distinct_words"), "n_upper", "n_exclamations", "n_bars")
    return counts.select(*restored(inner), *[c for c in counts.columns if c not in kept], *[
        F.expr(f"coalesce(try_divide({a}, {b}), 0.0D)").alias(f"f_{name}")
        for name, rule in FEATURES.items() for a, _, b in [rule.partition(" / ") if " / " in rule else (rule, "", "1")]])


def base_failed() -> Column:
    """Fewer than 20 words, or over 30 % of the words in repeated windows."""
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def learn_rules(labelled: DataFrame, label: str = "quality", bins: int = 24, max_rules: int = 8, max_conditions: int = 4,
                min_precision: float = 0.9, min_rows: int = 5) -> list[Rule]:
    """A decision list that rejects rows of label 0, from ``text_statistics`` joined with labels."""
    rows = labelled.where(F.col(label).isin(0, 1))
    names = list(FEATURES)
    # Most rates are zero for most texts, so quantiles of the other values count too.
    shares = [k / bins for k in range(bins)]
    cuts = rows.agg(*[F.percentile_approx(F.when(seen, F.col(f"f_{n}")), shares, 10_000).alias(f"{n}{k}")
                      for n in names for k, seen in enumerate((F.lit(True), F.col(f"f_{n}") > 0))]).first()
    thresholds = {n: sorted({*(cuts[f"{n}0"] or []), *(cuts[f"{n}1"] or [])}) for n in names}
    if not any(thresholds.values()):
        return []
    fold = F.xxhash64(*[f"f_{n}" for n in names])
    binned = cut(rows.select(
        (F.col(label) == 0).alias("bad"), (F.pmod(fold, F.lit(3)) == 0).alias("prune"),
        *[_bin(F.col(f"f_{n}"), thresholds[n]).alias(n) for n in names]), "rules")
    rules: list[Rule] = []
    left = F.lit(True)
    for _ in range(max_rules):
        grown = _grow(binned.where(left & ~F.col("prune")), names, thresholds, max_conditions, min_rows)
        kept = _prune(binned.where(left & F.col("prune")), grown, min_precision)
        if not kept:
            break
        rules.append(tuple(Condition(n, up, thresholds[n][k - 1]) for n, up, k in kept))
        left = left & ~_covers(kept)
    return rules


Test = tuple[str, bool, int]


def _bin(value: Column, thresholds: list[float]) -> Column:
    """How many thresholds ``value`` reaches."""
    return F.size(F.filter(F.lit(thresholds).cast("array<double>"), lambda t: t <= value))


def _covers(tests: list[Test]) -> Column:
    covered = F.lit(True)
    for name, up, k in tests:
        covered = covered & ((F.col(name) >= k) if up else (F.col(name) < k))
    return covered


def _grow(rows: DataFrame, names: list[str], thresholds: dict[str, list[float]], most: int, min_rows: int) -> list[Test]:
    tests: list[Test] = []
    while len(tests) < most:
        counted = rows.where(_covers(tests)).select("bad", F.explode(F.array(*[
            F.struct(F.lit(n).alias("f"), F.col(n).alias("b")) for n in names])).alias("e")).groupBy("e.f", "e.b").agg(
            F.count_if("bad").alias("bad"), F.count_if(~F.col("bad")).alias("good")).collect()
        table = {n: [[0, 0] for _ in range(len(thresholds[n]) + 1)] for n in names}
        for r in counted:
            table[r["f"]][r["b"]] = [r["bad"], r["good"]]
        bad, good = (sum(x[k] for x in table[names[0]]) for k in (0, 1))
        if not bad or not good:
            break
        before, best = math.log2(bad / (bad + good)), (0.0, None)
        for n in names:
            low = [0, 0]
            for k in range(1, len(table[n])):
                low = [low[0] + table[n][k - 1][0], low[1] + table[n][k - 1][1]]
                for up, (p, q) in ((True, (bad - low[0], good - low[1])), (False, tuple(low))):
                    if p >= min_rows and (gain := p * (math.log2(p / (p + q)) - before)) > best[0] + 1e-9:
                        best = (gain, (n, up, k))
        if best[1] is None:
            break
        tests.append(best[1])
    return tests


def _prune(rows: DataFrame, tests: list[Test], min_precision: float) -> list[Test]:
    """The opening conditions that do best on the pruning rows, or none if even they are imprecise."""
    if not tests:
        return []
    starts = [tests[:k] for k in range(1, len(tests) + 1)]
    seen = rows.agg(*[F.count_if(_covers(t) & wanted).alias(f"{k}{kind}") for k, t in enumerate(starts)
                      for kind, wanted in (("p", F.col("bad")), ("n", ~F.col("bad")))]).first()
    scored = [((p - n) / (p + n), -len(t), p / (p + n), t) for k, t in enumerate(starts)
              for p, n in [(seen[f"{k}p"], seen[f"{k}n"])] if p + n]
    if not scored:
        return []
    _, _, precision, best = max(scored, key=lambda s: s[:2])
    return best if precision >= min_precision else []


def verdict(rules: list[Rule]) -> Column:
    """Number of the first rule that fires, from 1; null if none does."""
    found = None
    for k, rule in enumerate(rules, 1):
        fires = F.lit(True)
        for condition in rule:
            fires = fires & condition.column()
        found = F.when(fires, k) if found is None else found.when(fires, k)
    return F.lit(None).cast("int") if found is None else found


def label_statistics(docs: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality") -> DataFrame:
    """Statistics of the labelled texts only; ``docs`` are whole rows."""
    # Labels grow with the texts: one plan at every size, without a broadcast while they happen to be few.
    chosen = labels.select(F.col(key).alias("__key"), F.col(label).alias("__label")).where("__key is not null").hint("merge")
    joined = docs.select(key, "text").join(chosen, F.col(key) == F.col("__key"))
    return text_statistics(joined, keep=["__label"]).withColumnRenamed("__label", label)


def apply_rules(statistics: DataFrame, rules: list[Rule]) -> DataFrame:
    """With base_failed, rule (number of the deciding rule, null if none) and kept."""
    kept = [f"`{c}`" for c in statistics.columns if c.lower() not in ("base_failed", "rule", "kept")]
    judged = statistics.select(*kept, base_failed().alias("base_failed"), verdict(rules).alias("rule"))
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
