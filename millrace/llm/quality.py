"""Quality rules as a learned decision list, in DataFrame operations only.

Statistics of every text are Spark expressions. Sequential covering on the
statistics of labelled texts grows conjunctions of thresholds on one part of
the sample and prunes them on the other; the ordered rules become one Spark
conditional expression. Only numbers of a bounded sample reach the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import rows_of

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30

#: Labelled rows to learn from, for each label; smallest hashes first.
SAMPLE_PER_LABEL = 10_000
#: Thresholds tried for each statistic: quantiles of the sample.
CUTS = 200
MAX_RULES, MAX_CONDITIONS = 12, 4
#: A rule stays if so much of what it covers in the pruning part is bad, and it covers enough rows.
LEAST_PRECISION, LEAST_COVER = 0.9, 3

FEATURES = ("words", "word_length", "symbol_share", "upper_share", "bang_share", "dup_line_share", "repeat_share", "line_words")


def statistics(docs: DataFrame) -> DataFrame:
    """``docs`` (with ``text``) plus the base statistics and ``FEATURES``; null text counts as empty.

    Repeats are found inside each row: window hashes of one text are sorted
    with their places, so nothing is exploded or shuffled. (``slice`` would copy
    the whole array for every window; single elements are read in place.)
    """
    text = F.coalesce("text", F.lit(""))
    d = docs.withColumn("_t", text).withColumn("_w", F.array_remove(F.split("_t", r"[\x20\x09-\x0D]+"), ""))
    n = F.size("_w")
    places = F.when(n >= WINDOW, F.sequence(F.lit(0), n - WINDOW)).otherwise(F.array().cast("array<int>"))
    d = d.withColumn("_h", F.transform(places, lambda i: F.xxhash64(*(F.get("_w", i + j) for j in range(WINDOW)))))
    sorted_windows = F.array_sort(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    d = d.withColumn("_s", F.when(F.size(F.array_distinct("_h")) < F.size("_h"), sorted_windows))
    starts = F.array_sort(F.transform(F.filter("_s", lambda x, k: F.coalesce(F.get("_s", k - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get("_s", k + 1)["h"] == x["h"], F.lit(False))), lambda x: x["i"]))
    covered = F.aggregate(
        starts,
        F.struct(F.lit(-1).alias("end"), F.lit(0).alias("sum")),
        lambda acc, i: F.struct((i + WINDOW).alias("end"), (acc["sum"] + WINDOW - F.greatest(F.lit(0), acc["end"] - i)).alias("sum")),
    )["sum"]
    lines = F.filter(F.split("_t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    d = (
        d.withColumn("n_words", n.cast("long"))
        .withColumn("word_chars", F.char_length(F.array_join("_w", "")).cast("long"))
        .withColumn("n_symbols", F.regexp_count("_t", F.lit("[#*$%&|<>]")).cast("long"))
        .withColumn("_u", F.regexp_count("_t", F.lit("[A-Z]")))
        .withColumn("_b", F.regexp_count("_t", F.lit("!")))
        .withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
        .withColumn("_l", lines)
        .withColumn("_n_lines", F.size("_l"))
        .withColumn("n_dup_lines", (F.col("_n_lines") - F.size(F.array_distinct("_l"))).cast("long"))
        .withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    )
    chars, total, n_lines = F.greatest("word_chars", F.lit(1)), F.greatest("n_words", F.lit(1)), F.greatest("_n_lines", F.lit(1))
    values = (
        F.col("n_words").cast("double"), F.col("word_chars") / total, F.col("n_symbols") / chars, F.col("_u") / chars,
        F.col("_b") / chars, F.col("n_dup_lines") / n_lines, F.col("n_repeat_words") / total, F.col("n_words") / n_lines,
    )
    return d.select(*docs.columns, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", *(v.alias(f"f_{name}") for name, v in zip(FEATURES, values, strict=True)))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, row: dict[str, float]) -> bool:
        return row[self.feature] >= self.threshold if self.above else row[self.feature] <= self.threshold

    def column(self) -> Column:
        c = F.col(f"f_{self.feature}")
        return c >= self.threshold if self.above else c <= self.threshold


@dataclass
class DecisionList:
    """Rules for bad texts, in order; what no rule covers is good."""

    rules: list[list[Condition]] = field(default_factory=list)

    def column(self) -> Column:
        out: Column | None = None
        for rule in self.rules:
            test = F.lit(True)
            for c in rule:
                test = test & c.column()
            out = F.when(test, False) if out is None else out.when(test, False)
        return F.lit(True) if out is None else out.otherwise(True)

    def __str__(self) -> str:
        return "\n".join("if " + " and ".join(f"{c.feature} {'>=' if c.above else '<='} {c.threshold:.6g}" for c in r) + ": bad" for r in self.rules) + "\nelse good"


#: Labelled rows that a row of the sample stands for, by label (0 bad, 1 good).
EVEN = {0: 1.0, 1: 1.0}


def counts(rows: list[tuple[dict, int]], shares: dict[int, float] = EVEN) -> tuple[float, float]:
    """(bad, good) rows of the whole table that ``rows`` stand for."""
    bad = sum(1 for _, good in rows if not good)
    return bad * shares[0], (len(rows) - bad) * shares[1]


def best_condition(rows: list[tuple[dict, int]], shares: dict[int, float] = EVEN) -> tuple[float, Condition | None]:
    """The condition of the highest information gain on bad rows (FOIL)."""
    bad, good = counts(rows, shares)
    base, best = math.log2(bad / (bad + good)), (1e-9, None)
    for name in FEATURES:
        pairs = sorted((r[name], g) for r, g in rows)
        step = max(1, len(pairs) // CUTS)
        b = g = 0.0
        for i, (value, is_good) in enumerate(pairs):
            b, g = (b, g + shares[1]) if is_good else (b + shares[0], g)
            last = i + 1 == len(pairs)
            if last or (i + 1) % step and pairs[i + 1][1] == is_good or pairs[i + 1][0] == value:
                continue
            middle = (value + pairs[i + 1][0]) / 2
            for above, p, n in ((False, b, g), (True, bad - b, max(0.0, good - g))):
                if p > 1e-6 and (gain := p * (math.log2(p / (p + n)) - base)) > best[0]:
                    best = (gain, Condition(name, above, middle))
    return best


def covered(rule: list[Condition], rows: list[tuple[dict, int]]) -> list[tuple[dict, int]]:
    return [r for r in rows if all(c.holds(r[0]) for c in rule)]


def learn(rows: list[tuple[dict, int, int]], shares: dict[int, float] = EVEN) -> DecisionList:
    """Sequential covering on (statistics, good, fold): fold 0 of 3 prunes, the others grow.

    Gain and precision are those of the whole table, by ``shares``; the least cover is one of rows seen.
    """
    grow, prune = [(s, g) for s, g, f in rows if f], [(s, g) for s, g, f in rows if not f]
    out = DecisionList()
    while len(out.rules) < MAX_RULES and counts(grow)[0] and counts(prune)[0]:
        rule, left = [], grow
        while len(rule) < MAX_CONDITIONS and all(counts(left)):
            condition = best_condition(left, shares)[1]
            if condition is None:
                break
            rule.append(condition)
            left = covered([condition], left)

        def worth(k: int, rule: list[Condition] = rule) -> tuple[float, int]:
            bad, good = counts(covered(rule[:k], prune), shares)
            return ((bad - good) / (bad + good or 1), -k)

        rule = rule[: max(range(1, len(rule) + 1), key=worth)] if rule else []
        bad, good = counts(covered(rule, prune), shares) if rule else (0, 0)
        if bad < LEAST_COVER * shares[0] or bad < LEAST_PRECISION * (bad + good):
            break
        out.rules.append(rule)
        grow, prune = ([r for r in part if not all(c.holds(r[0]) for c in rule)] for part in (grow, prune))
    return out


def train(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DecisionList:
    """Learn from labels (doc_id, quality) of texts that pass the base rules; null labels are left out."""
    keyed = labels.select("doc_id", F.col("quality").cast("int").alias("good")).filter("doc_id is not null and good is not null")
    keyed = keyed.groupBy("doc_id").agg(F.max("good").alias("good")).withColumn("h", F.xxhash64("doc_id", F.lit(3)))
    sizes = {r["good"]: r["n"] for r in keyed.groupBy("good").agg(F.count(F.lit(1)).alias("n")).collect()}
    shares = {y: max(1.0, sizes.get(y, 0) / SAMPLE_PER_LABEL) for y in EVEN}
    picks = [keyed.filter(F.col("good") == y).orderBy("h").limit(SAMPLE_PER_LABEL) for y in (0, 1)]
    sample = F.broadcast(picks[0].unionAll(picks[1]))  # 2 * SAMPLE_PER_LABEL rows of three numbers at most
    labelled = statistics(rows_of(df, id_col, text_col).join(sample, "doc_id"))
    # base_failed is tested here: a filter would be pushed below the projections and copy their expressions.
    rows = labelled.select("h", "good", "base_failed", F.pmod("h", F.lit(3)).alias("fold"), *(f"f_{x}" for x in FEATURES)).collect()
    rows = sorted(r for r in rows if not r["base_failed"])
    return learn([({x: r[f"f_{x}"] for x in FEATURES}, r["good"], r["fold"]) for r in rows], shares)


def quality(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: DecisionList | None = None) -> DataFrame:
    """doc_id, base statistics, base_failed, kept of each row.

    Null and empty texts have no words and fail the base rules. Rows stand
    alone, so null ids and repeated rows pass; without usable labels the list
    is empty and keeps all that the base rules keep.
    """
    rules = rules or train(df, labels, id_col, text_col)
    out = statistics(rows_of(df, id_col, text_col))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", F.when(F.col("base_failed"), False).otherwise(rules.column()).alias("kept"))
