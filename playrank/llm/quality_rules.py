"""Quality rules: text statistics and a learned decision list, in DataFrame functions only.

The list is learned by sequential covering. A rule is a conjunction of thresholds on the statistics below; it grows one
condition at a time by information gain on two thirds of the labelled rows, is pruned on the last third, and is kept only
while it is precise there. Rows it covers are set aside and the next rule is learned on the rest. Counting is one grouped
aggregate per step, so the driver sees (feature, bin) counts and never rows. The result is an ordered CASE expression.

All statistics of a text are made inside its row: no word is ever shuffled.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playrank.session import materialize

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
BINS = 32
#: Labelled rows to learn from: above it a share is drawn by hash. It bounds learning, not what the rules apply to.
MAX_LABELLED = 200_000

#: Ratios that do not depend on a text's length, and the length itself.
FEATURES = {
    "chars_per_word": "word_chars / n_words",
    "symbols_per_word": "n_symbols / n_words",
    "dup_line_share": "n_dup_lines / n_lines",
    "repeat_word_share": "n_repeat_words / n_words",
    "upper_share": "n_upper / word_chars",
    "digit_share": "n_digits / word_chars",
    "mark_share": "n_marks / word_chars",
    "distinct_word_share": "n_distinct_words / n_words",
    "words_per_line": "n_words / n_lines",
    "n_words": "n_words",
}


def _without(text: Column, chars: str) -> Column:
    return F.length(F.translate(text, chars, ""))


def text_statistics(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and one bigint column per statistic of ``text``; null counts as empty."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = docs.select(*keep, text.alias("__t"))
    base = base.withColumn("__w", F.filter(F.split("__t", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    starts = F.sequence(F.lit(1), F.size("__w") - (WINDOW - 1))
    runs = F.when(F.size("__w") >= WINDOW, F.transform(starts, lambda i: F.xxhash64(F.slice("__w", i, WINDOW))))
    base = base.withColumns({"__runs": runs, "__lines": F.filter(F.split("__t", "\n", -1), lambda x: F.length(F.translate(x, SPACES, "")) > 0)})
    # The windows of most texts all differ; only the others are sorted to find which repeat.
    repeats = F.size(F.array_distinct("__runs")) < F.size("__runs")
    base = base.withColumn("__sorted", F.when(repeats, F.sort_array(F.transform("__runs", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    twin = F.transform(
        "__sorted",
        lambda x, k: F.when(F.get("__sorted", k - 1)["h"].eqNullSafe(x["h"]) | F.get("__sorted", k + 1)["h"].eqNullSafe(x["h"]), x["i"]),
    )
    base = base.withColumn("__again", F.sort_array(F.filter(twin, lambda i: i.isNotNull())))
    start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("bigint").alias("total"))
    covered = F.aggregate("__again", start, lambda a, i: F.struct(i.alias("last"), (a["total"] + F.least(F.lit(WINDOW), i - a["last"])).alias("total")))
    n = F.length("__t")
    stats = {
        "n_words": F.size("__w"),
        "word_chars": _without(F.col("__t"), SPACES),
        "n_symbols": n - _without(F.col("__t"), SYMBOLS),
        "n_lines": F.size("__lines"),
        "n_dup_lines": F.size("__lines") - F.size(F.array_distinct("__lines")),
        "n_repeat_words": F.coalesce(covered["total"], F.lit(0)),
        "n_distinct_words": F.size(F.array_distinct("__w")),
        "n_upper": n - _without(F.col("__t"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        "n_digits": n - _without(F.col("__t"), "0123456789"),
        "n_marks": n - _without(F.col("__t"), "!?.,;:\"'()[]{}"),
    }
    return base.select(*keep, *[v.cast("bigint").alias(k) for k, v in stats.items()])


STATISTICS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_distinct_words", "n_upper", "n_digits", "n_marks"]


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def feature(name: str) -> Column:
    """The statistic's value; a ratio over nothing is 0."""
    top, _, bottom = FEATURES[name].partition(" / ")
    return F.coalesce(F.try_divide(F.col(top).cast("double"), F.col(bottom)), F.lit(0.0)) if bottom else F.col(top).cast("double")


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = feature(self.feature)
        return value > F.lit(self.threshold) if self.above else value <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:g}"


Rule = tuple[Condition, ...]


def rule_column(rule: Rule) -> Column:
    return reduce(lambda a, b: a & b, [c.column() for c in rule])


def decision_list(rules: list[Rule]) -> Column:
    """Number of the first rule that holds, 0 if none does."""
    result = None
    for number, rule in enumerate(rules, 1):
        result = F.when(rule_column(rule), number) if result is None else result.when(rule_column(rule), number)
    return (F.lit(0) if result is None else result.otherwise(0)).cast("int")


@dataclass(frozen=True)
class RuleConfig:
    max_rules: int = 10
    max_conditions: int = 3
    min_precision: float = 0.9
    min_covered: int = 5
    max_labelled: int = MAX_LABELLED


def learn_rules(statistics: DataFrame, labels: DataFrame, config: RuleConfig | None = None) -> list[Rule]:
    """Rules that pick out rows with quality 0. ``statistics`` has doc_id, ``labels`` doc_id and quality."""
    config = config or RuleConfig()
    bad = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg((F.min("quality") == 0).alias("bad"))
    rows = statistics.where(~base_failed()).join(bad, "doc_id")
    labelled = rows.count()
    draw = F.pmod(F.xxhash64(F.lit("labelled"), "doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    if labelled > config.max_labelled:
        rows = rows.where(draw < config.max_labelled / labelled)
    grow = F.pmod(F.xxhash64(F.lit("grow"), "doc_id"), F.lit(3)) < 2
    train = materialize(rows.select(*STATISTICS, "bad", grow.alias("grow")), "labelled")

    names = list(FEATURES)
    points = [k / BINS for k in range(1, BINS)]
    cuts = train.agg(*[F.percentile_approx(feature(n), points, 10_000).alias(n) for n in names]).first()
    edges = {n: sorted(set(cuts[n] or [])) for n in names}

    def bin_of(name: str) -> Column:
        passed = [(feature(name) > F.lit(t)).cast("int") for t in edges[name]]
        return reduce(lambda a, b: a + b, passed, F.lit(0))

    binned = materialize(train.select(*STATISTICS, "bad", "grow", F.array(*[bin_of(n) for n in names]).alias("bins")), "binned")
    rules: list[Rule] = []
    left = binned
    while len(rules) < config.max_rules:
        rule = _grow(left.where("grow"), names, edges, config)
        rule = _prune(left.where("NOT grow"), rule, config) if rule else None
        if not rule:
            break
        rules.append(rule)
        left = left.where(~rule_column(rule))
    return rules


def _grow(rows: DataFrame, names: list[str], edges: dict[str, list[float]], config: RuleConfig) -> Rule:
    rule: Rule = ()
    while len(rule) < config.max_conditions:
        covered = rows.where(rule_column(rule)) if rule else rows
        counts = covered.select("bad", F.posexplode("bins").alias("f", "b")).groupBy("f", "b").agg(F.count_if("bad").alias("p"), F.count_if(~F.col("bad")).alias("n")).collect()  # features x bins
        total_p = sum(r["p"] for r in counts if r["f"] == 0)
        total_n = sum(r["n"] for r in counts if r["f"] == 0)
        if total_p < config.min_covered or total_n == 0:
            break
        before = math.log2(total_p / (total_p + total_n))
        best: tuple[float, Condition] | None = None
        for f, name in enumerate(names):
            table = {r["b"]: (r["p"], r["n"]) for r in counts if r["f"] == f}
            p = n = 0
            for b, threshold in enumerate(edges[name]):
                p, n = p + table.get(b, (0, 0))[0], n + table.get(b, (0, 0))[1]
                for above, (cp, cn) in ((False, (p, n)), (True, (total_p - p, total_n - n))):
                    if cp < config.min_covered:
                        continue
                    gain = cp * (math.log2(cp / (cp + cn)) - before)
                    if gain > 0 and (best is None or gain > best[0]):
                        best = (gain, Condition(name, above, threshold))
        if best is None or best[1] in rule:
            break
        rule = (*rule, best[1])
    return rule


def _prune(rows: DataFrame, rule: Rule, config: RuleConfig) -> Rule | None:
    """The beginning of the rule with the best (p - n) / (p + n) on rows not grown on, if precise enough there."""
    heads = [rule[: k + 1] for k in range(len(rule))]
    counted = []
    for k, head in enumerate(heads):
        counted += [F.count_if(rule_column(head) & F.col("bad")).alias(f"p{k}"), F.count_if(rule_column(head) & ~F.col("bad")).alias(f"n{k}")]
    found = rows.agg(*counted).first()
    scored = [((found[f"p{k}"] - found[f"n{k}"]) / max(1, found[f"p{k}"] + found[f"n{k}"]), -k) for k in range(len(heads))]
    k = -max(scored)[1]
    p, n = found[f"p{k}"], found[f"n{k}"]
    return heads[k] if p + n > 0 and p >= config.min_precision * (p + n) else None


def judge_quality(docs: DataFrame, labels: DataFrame, config: RuleConfig | None = None) -> DataFrame:
    """(doc_id, statistics, base_failed, rule, kept) for every row of ``docs`` (doc_id, text, ...).

    A row is kept if it passes the base limits and no learned rule holds; ``rule`` is the number of the rule that does, else 0.
    Null and empty texts have no words and fail the base. Without labelled rows of both kinds the list is empty. Repeated
    rows are judged alike, an empty table gives no rows, other columns are left aside whatever their names.
    """
    statistics = materialize(text_statistics(docs, ["doc_id"]), "statistics")  # one pass over the texts
    rules = learn_rules(statistics, labels, config)
    judged = statistics.withColumns({"base_failed": base_failed(), "rule": decision_list(rules)})
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))


def filter_quality(docs: DataFrame, labels: DataFrame, config: RuleConfig | None = None) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns as they are; texts are looked at once and never shuffled."""
    renamed = docs.select(*[F.col(c).alias(f"__in_{c}") for c in docs.columns], "doc_id", "text")
    passed = materialize(text_statistics(renamed, ["doc_id", *[f"__in_{c}" for c in docs.columns]]), "statistics")
    rules = learn_rules(passed.select("doc_id", *STATISTICS), labels, config)
    kept = passed.where(~base_failed() & (decision_list(rules) == 0))
    return kept.select(*[F.col(f"__in_{c}").alias(c) for c in docs.columns])
