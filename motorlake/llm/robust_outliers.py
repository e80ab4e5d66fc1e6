"""Quality rules with robust multivariate outliers (DataFrame operations only).

Counts come from array functions inside a row. For each language and source, a minimum
covariance determinant estimate of four transformed statistics is found by concentration
steps; documents far from it by Mahalanobis distance are rejected.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motorlake.llm.common import saved

SPACE = r"[\x20\x09-\x0D]+"          # a word is a run of anything else
SYMBOLS = "#*$%&|<>"
LEAST_WORDS, MOST_REPEATED = 50, 50   # base rules: fewer words, or more per cent of repeated words, fail
DIM = 4
UNIT = 1024                            # statistics are whole multiples of 1/UNIT, so all sums are exact
COVERED = 0.75                         # share of a group that the estimate is taken from
STEPS = 6                              # concentration steps from each start
BINS = 32                              # bins of squared distance per unit of its logarithm
#: Fixed values for 4 statistics and COVERED 0.75: the consistency factor of the covariance,
#: 0.75 / P(chi2_6 <= chi2_4's 0.75 quantile), and chi2_4's 0.9999 quantile.
CONSISTENCY, CUTOFF = 1.4851, 23.5127
FLOORS = (0.12, 0.6, 0.6, 0.6)         # least standard deviations: most texts have no symbol or repeat at all
LEAST_GROUP = 60                       # smaller groups take their language's estimate, small languages that of all

CELLS = [(i, j) for i in range(DIM) for j in range(i + 1)]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` worked out once, also where lambdas in ``body`` use it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE, -1), lambda w: w != "")


def repeated_words(words: Column) -> Column:
    """Words that lie in a 3-word window found twice or more, the first time included.

    Windows are compared by 64-bit hashes: sorted with their places, equal neighbours are repeats.
    """
    def of_windows(hashes: Column) -> Column:
        def of_sorted(s: Column) -> Column:
            again = F.filter(s, lambda x, k: (x["h"] == F.get(s, k - 1)["h"]).eqNullSafe(True) | (x["h"] == F.get(s, k + 1)["h"]).eqNullSafe(True))
            return F.size(F.array_distinct(F.flatten(F.transform(again, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))

        places = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(let(places, of_sorted))

    def of_words(w: Column) -> Column:
        hashes = F.transform(F.slice(w, F.lit(1), F.greatest(F.size(w) - 2, F.lit(0))), lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
        return F.when(F.size(w) < 4, F.lit(0)).otherwise(let(hashes, of_windows))

    return let(words, of_words)


def base_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    words = docs.select("doc_id", "lang", "source", text.alias("text"), words_of(F.col("text")).alias("words"))
    counts = words.select(
        "doc_id", "lang", "source", F.size("words").cast("bigint").alias("n_words"),
        F.length(F.translate("text", " \t\n\x0b\f\r", "")).cast("bigint").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
        repeated_words(F.col("words")).cast("bigint").alias("n_repeat_words"))
    return counts.withColumn("base_failed", (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")))


def transformed() -> list[Column]:
    """Word length and shares of symbols, repeated lines and repeated words, on log scales in steps of 1/UNIT."""
    per = lambda c: F.log1p(100.0 * F.col(c) / F.col("n_words"))
    return [F.round(UNIT * x).cast("bigint") for x in
            (F.log(F.col("word_chars") / F.col("n_words")), per("n_symbols"), per("n_dup_lines"), per("n_repeat_words"))]


def factor(estimates: DataFrame) -> DataFrame:
    """Adds the Cholesky factor l00 .. l33 of the covariance c00 .. c33 and its log determinant.

    The covariance is made consistent and its variances are raised to the floors first, which keeps it positive definite.
    """
    out = estimates
    for i, j in CELLS:
        c = CONSISTENCY * F.col(f"c{i}{j}")
        out = out.withColumn(f"c{i}{j}", F.greatest(c, F.lit(FLOORS[i] ** 2)) if i == j else c)
    for i, j in CELLS:
        rest = F.col(f"c{i}{j}")
        for k in range(j):
            rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        out = out.withColumn(f"l{i}{j}", F.sqrt(F.greatest(rest, F.lit(1e-12))) if i == j else rest / F.col(f"l{j}{j}"))
    det = F.lit(0.0)
    for i in range(DIM):
        det = det + 2 * F.log(f"l{i}{i}")
    return out.withColumn("log_det", det)


def squared_distance() -> Column:
    """Squared Mahalanobis distance of x0 .. x3 from m0 .. m3 by the factor l00 .. l33."""
    z, total = [], F.lit(0.0)
    for i in range(DIM):
        rest = F.col(f"x{i}") / F.lit(float(UNIT)) - F.col(f"m{i}")
        for k in range(i):
            rest = rest - F.col(f"l{i}{k}") * z[k]
        z.append(rest / F.col(f"l{i}{i}"))
        total = total + z[i] * z[i]
    return total


def _moments(counts: DataFrame) -> DataFrame:
    """m0 .. and c00 .. from the exact sums n, s0 .., q00 .."""
    n = F.col("n").cast("double")
    means = [(F.col(f"s{i}") / n / UNIT).alias(f"m{i}") for i in range(DIM)]
    cells = [(F.col(f"q{i}{j}") / n / (UNIT * UNIT) - (F.col(f"s{i}") / n / UNIT) * (F.col(f"s{j}") / n / UNIT)).alias(f"c{i}{j}") for i, j in CELLS]
    return counts.select("group", "start", *means, *cells)


SUMS = [f"s{i}" for i in range(DIM)] + [f"q{i}{j}" for i, j in CELLS]


def _sums() -> list[Column]:
    return [F.count("*").alias("n"), *(F.sum(f"x{i}").alias(f"s{i}") for i in range(DIM)),
            *(F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"q{i}{j}") for i, j in CELLS)]


def _starts(rows: DataFrame) -> DataFrame:
    """Two starts a group: medians with quartile spreads and no correlation; plain means and covariances."""
    long = rows.select("group", F.posexplode(F.array(*[f"x{i}" for i in range(DIM)])).alias("i", "x"))
    counted = saved(long.groupBy("group", "i", "x").agg(F.count("*").alias("n")), "value-counts")
    each = Window.partitionBy("group", "i")
    run = counted.withColumn("upto", F.sum("n").over(each.orderBy("x"))).withColumn("all", F.sum("n").over(each))
    at = lambda q: F.min(F.when(F.col("upto") >= q * F.col("all"), F.col("x")))
    quartiles = run.groupBy("group", "i").agg(at(0.25).alias("lo"), at(0.5).alias("mid"), at(0.75).alias("hi"))
    pick = lambda i, c: F.max(F.when(F.col("i") == i, F.col(c)))
    spread = (F.col("hi") - F.col("lo")) / (1.349 * UNIT)
    wide = quartiles.withColumn("mid", F.col("mid") / UNIT).withColumn("var", spread * spread).groupBy("group").agg(
        *(pick(i, "mid").alias(f"m{i}") for i in range(DIM)), *(pick(i, "var").alias(f"c{i}{i}") for i in range(DIM)))
    robust = wide.select("group", F.lit(0).alias("start"), *[f"m{i}" for i in range(DIM)],
                         *(F.col(f"c{i}{j}") if i == j else F.lit(0.0).alias(f"c{i}{j}") for i, j in CELLS))
    plain = _moments(rows.groupBy("group").agg(*_sums()).withColumn("start", F.lit(1)))
    return robust.unionByName(plain)


def mcd_estimates(rows: DataFrame, steps: int = STEPS) -> DataFrame:
    """The minimum covariance determinant estimate of each ``group`` of x0 .. x3 rows.

    A concentration step takes the COVERED part of a group nearest to the current estimate and
    estimates anew from it; the determinant never grows beyond what the bins of distance round. Each step is one
    aggregation to (group, start, distance bin), whose running sums give the next
    estimate: no row is sorted, and a group of any size costs its bins only. Of the two
    starts the smaller determinant wins.
    """
    now = saved(factor(_starts(rows)), "mcd")
    bin_ = F.floor(F.log(squared_distance() + 1e-6) * BINS).cast("int").alias("bin")
    xs = [f"x{i}" for i in range(DIM)]
    for _ in range(steps):
        near = rows.join(now, "group").select("group", "start", bin_, *xs)
        binned = saved(near.groupBy("group", "start", "bin").agg(*_sums()), "mcd-bins")
        upto = Window.partitionBy("group", "start").orderBy("bin")
        whole = Window.partitionBy("group", "start")
        run = binned.select("group", "start", "bin", F.sum("n").over(whole).alias("all"), *(F.sum(c).over(upto).alias(c) for c in ["n", *SUMS]))
        chosen = run.filter(F.col("n") >= COVERED * F.col("all")).groupBy("group", "start").agg(*(F.min_by(c, "bin").alias(c) for c in ["n", *SUMS]))
        now = saved(factor(_moments(chosen)), "mcd")
    best = now.groupBy("group").agg(F.min_by("start", F.struct("log_det", "start")).alias("start"))
    return saved(now.join(best, ["group", "start"]).select("group", *[f"m{i}" for i in range(DIM)], *[f"l{i}{j}" for i, j in CELLS]), "mcd-best")


def group_names() -> list[Column]:
    """The group of a row by language and source, by language, and of all rows; NULL is a value of its own."""
    lang, source = (F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("-")) for c in ("lang", "source"))
    return [F.concat_ws("\u0001", F.lit("s"), lang, source), F.concat_ws("\u0001", F.lit("l"), lang), F.lit("a")]


def quality_rules(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, distance).

    Words are runs of characters other than blank and \\x09 to \\x0D. The base rules fail texts of
    under 50 words or with over half of their words repeated. Texts that pass are kept where their squared
    robust distance in their language and source is at most CUTOFF; ``distance`` is NULL for texts that
    fail the base rules. NULL text: no words. NULL lang or source: a group of its own. Groups of under
    LEAST_GROUP passing texts use their language's estimate, small languages that of all texts. Equal rows get
    equal results; an empty table gives no row; other columns are ignored.
    """
    own, lang, every = group_names()
    stats = saved(base_statistics(docs).withColumn("group", own).withColumn("lang_group", lang)
                  .withColumns({f"x{i}": F.when(~F.col("base_failed"), x) for i, x in enumerate(transformed())})
                  .drop("lang", "source"), "statistics")
    xs = [f"x{i}" for i in range(DIM)]
    passing = stats.filter(~F.col("base_failed"))
    sizes = saved(passing.groupBy("group", "lang_group").agg(F.count("*").alias("n")), "group-sizes")
    langs = sizes.groupBy("lang_group").agg(F.sum("n").alias("lang_n"))
    use = saved(sizes.join(langs, "lang_group").select("group", F.when(F.col("n") >= LEAST_GROUP, F.col("group"))
                .when(F.col("lang_n") >= LEAST_GROUP, F.col("lang_group")).otherwise(every).alias("use")), "group-use")
    wanted = saved(use.select(F.col("use").alias("group")).distinct(), "wanted-groups")
    # a row counts in its own group, and in its language's and that of all only where some group needs them
    levels = passing.select(F.explode(F.array(F.col("group"), F.col("lang_group"), every)).alias("group"), *xs)
    rows = saved(levels.join(wanted, "group", "left_semi"), "mcd-rows")
    best = mcd_estimates(rows)
    chosen = saved(use.join(best.withColumnRenamed("group", "use"), "use").drop("use"), "group-estimates")
    d2 = F.when(~F.col("base_failed"), squared_distance())
    return stats.join(chosen, "group", "left").withColumn("d2", d2).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.coalesce(F.col("d2") <= CUTOFF, F.lit(True))).alias("kept"), F.sqrt("d2").alias("distance"))
