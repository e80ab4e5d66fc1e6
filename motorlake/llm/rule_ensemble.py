"""Quality classifier: a sparse ensemble of rules.

Shallow trees over text statistics give conjunctive rules (every path from a root), a lasso
logistic regression weighs them, and the rules with a weight become one Spark column expression.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motorlake.llm.common import held_out, saved

MAX_LABELLED = 12_000      # labelled rows learned from at most, the least hashes of the id
TREES, DEPTH, LASSO = 24, 3, 0.002
CUT = 0.7

STATISTICS = ["log_words", "chars_per_word", "upper_share", "symbols_per_word", "marks_per_word", "digits_per_word",
              "stops_per_word", "distinct_words", "distinct_lines", "words_per_line", "short_words"]


def statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """Text statistics of every whole text; empty and NULL texts have 0 in all of them."""
    text = F.coalesce(F.col("text"), F.lit(""))
    split = docs.select(*keep, text.alias("text"), F.filter(F.split(text, r"\s+", -1), lambda w: w != "").alias("words"),
                        F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"\S")).alias("lines"))
    n, lines = F.size("words"), F.size("lines")
    per = lambda x, by=n: F.when(by > 0, x / by).otherwise(F.lit(0.0))
    count = lambda pattern: F.regexp_count("text", F.lit(pattern))
    return split.select(
        *keep, F.log1p(n.cast("double")).alias("log_words"), per(F.length("text")).alias("chars_per_word"),
        F.when(F.length("text") > 0, count(r"\p{Lu}") / F.length("text")).otherwise(F.lit(0.0)).alias("upper_share"),
        per(count(r"[#*$%&|<>{}\[\]@~^_=+/\\]")).alias("symbols_per_word"), per(count(r"[!?]")).alias("marks_per_word"),
        per(count(r"[0-9]")).alias("digits_per_word"), per(count(r"[.,;:]")).alias("stops_per_word"),
        per(F.size(F.array_distinct("words"))).alias("distinct_words"), per(F.size(F.array_distinct("lines")), lines).alias("distinct_lines"),
        per(n, lines).alias("words_per_line"), per(F.size(F.filter("words", lambda w: F.length(w) <= 3))).alias("short_words"))


Condition = tuple[int, str, float]      # statistic, "<=" or ">", bound


def tree_rules(debug: str) -> list[tuple[Condition, ...]]:
    """The distinct conjunctions on all paths from a root in a tree ensemble's text form."""
    found: dict[tuple[Condition, ...], None] = {}
    path: list[tuple[int, Condition]] = []
    for line in debug.splitlines():
        m = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if line.lstrip().startswith("Tree "):
            path = []
        elif m:
            depth = len(m[1])
            path = [p for p in path if p[0] < depth] + [(depth, (int(m[2]), m[3], float(m[4])))]
            bounds: dict[tuple[int, str], float] = {}
            for _, (f, op, x) in path:                     # the tightest bound of each side
                old = bounds.get((f, op))
                bounds[f, op] = x if old is None else min(old, x) if op == "<=" else max(old, x)
            found[tuple((f, op, x) for (f, op), x in sorted(bounds.items()))] = None
    return list(found)


def rule_column(rule: tuple[Condition, ...]) -> Column:
    out = F.lit(True)
    for f, op, x in rule:
        c = F.col(STATISTICS[f])
        out = out & ((c <= x) if op == "<=" else (c > x))
    return out


@dataclass
class RuleEnsemble:
    intercept: float
    rules: list[tuple[tuple[Condition, ...], float]]      # with the weight of each

    def score(self) -> Column:
        """The probability of label 1 as one expression over the statistics."""
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(rule_column(rule), F.lit(weight)).otherwise(F.lit(0.0))
        return 1.0 / (1.0 + F.exp(-total))

    def text(self) -> list[str]:
        return [f"{w:+.3f} " + " and ".join(f"{STATISTICS[f]} {op} {x:.4g}" for f, op, x in rule) for rule, w in self.rules]


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """Statistics and label of at most ``most`` labelled rows outside the held-out fold.

    A doc_id with several labels takes the least one. The chosen ids are bounded by ``most``, so they are broadcast.
    """
    usable = labels.filter(~held_out(F.col("doc_id")) & F.col(label).isNotNull())
    chosen = usable.groupBy("doc_id").agg(F.min(label).cast("double").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return saved(statistics(rows, "doc_id", "label"), "labelled")


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = MAX_LABELLED, trees: int = TREES,
          depth: int = DEPTH, lasso: float = LASSO) -> RuleEnsemble:
    """Fit the trees, take their rules and keep those that the lasso gives a weight.

    Without both labels in the sample the ensemble is a constant: their share of label 1, 0.5 without any.
    """
    sample = labelled_sample(docs, labels, label, most)
    n, ones = sample.agg(F.count("*"), F.sum("label")).first()
    if not n or ones in (0, n):
        return RuleEnsemble(0.0 if not n else 6.0 if ones else -6.0, [])
    vectors = VectorAssembler(inputCols=STATISTICS, outputCol="features").transform(sample).select("label", "features", *STATISTICS)
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, maxBins=64, seed=17, subsamplingRate=0.7, featureSubsetStrategy="sqrt").fit(vectors)
    rules = tree_rules(forest.toDebugString)
    if not rules:
        return RuleEnsemble(math.log(ones / (n - ones)), [])
    marked = sample.select("label", *(rule_column(r).cast("double").alias(f"r{i}") for i, r in enumerate(rules)))
    marked = saved(VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="rules").transform(marked).select("label", "rules"), "rule-marks")
    fit = LogisticRegression(featuresCol="rules", labelCol="label", elasticNetParam=1.0, regParam=lasso, maxIter=60, standardization=True).fit(marked)
    weights = fit.coefficients.toArray().tolist()
    return RuleEnsemble(float(fit.intercept), [(r, w) for r, w in zip(rules, weights) if abs(w) > 1e-6])


def score_documents(docs: DataFrame, model: RuleEnsemble, cut: float = CUT) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every whole text.

    NULL and empty texts are scored with all statistics 0. Only the text enters a score. Repeated
    rows get equal scores; other columns are ignored; an empty table gives no row.
    """
    scored = statistics(docs, "doc_id").withColumn("score", model.score())
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))
