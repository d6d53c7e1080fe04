"""Quality rules with risk-controlled thresholds.

Each document gets four counts. A fixed base rule rejects short and repetitive ones. What
passes is judged by threshold rules: for each stratum and rule, a grid of cutoffs is tested on
the labelled documents. A cutoff is admitted if an exact binomial test, at ``error`` divided by
the number of all tests (Bonferroni), shows that it rejects less than the rule's share of
``risk`` of the good documents. Shares add up to ``risk``, so that all rules together reject
less than ``risk`` of a stratum's good documents, in every stratum at once, with probability
``1 - error``. Of the admitted cutoffs the one that catches most bad documents is taken, of
equals the most lenient; a rule that catches less than ``least_catch`` of the bad is not used.
A stratum with too few labels to show anything rejects nothing beyond the base rule.

Everything is DataFrame functions; the counts of a document never leave its row.

Defined cases: a NULL or empty text has no words and fails the base rule; a NULL stratum is a
stratum of its own; repeated rows are judged each; labels for unknown documents, NULL labels
and NULL ids are ignored; a document with several labels counts once per label. Columns of the
input that bear the name of a result column are replaced.
"""

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.llm.words import text_or_empty, words
from tallyhouse.scratch import keep

SYMBOLS = r"[^#*$%&|<>]+"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
WINDOW = 3
_MASK = (1 << 24) - 1  # a window's position in a packed long


@dataclass(frozen=True)
class Rule:
    """Rejects a document whose ``numerator / denominator`` is at or above a cutoff."""

    name: str
    numerator: str
    denominator: str
    cutoffs: tuple[float, ...]


RULES = (
    Rule("symbols_per_word", "n_symbols", "n_words", (0.1, 0.2, 0.3, 0.5, 1.0)),
    Rule("repeated_lines", "n_dup_lines", "n_lines", (0.1, 0.2, 0.3, 0.5, 0.7)),
    Rule("repeated_words", "n_repeat_words", "n_words", (0.1, 0.2, 0.3, 0.4)),
)


def _window_hashes(found: Column) -> Column:
    at = F.sequence(F.lit(0), F.size(found) - WINDOW)
    hashed = F.transform(
        at, lambda i: F.xxhash64(*[F.get(found, i + k) for k in range(WINDOW)])
    )
    return F.when(F.size(found) >= WINDOW, hashed).otherwise(F.array().cast("array<bigint>"))


def _packed(hashes: Column) -> Column:
    """Hash and position of each window in one long, sorted; far cheaper than structs."""
    cut = ~_MASK
    return F.sort_array(
        F.transform(hashes, lambda h, i: h.bitwiseAND(cut).bitwiseOR(i.cast("long")))
    )


def _start(packed: Column) -> Column:
    return packed.bitwiseAND(_MASK).cast("int")


def _same_head(packed: Column, i: Column, step: int) -> Column:
    here, there = F.get(packed, i), F.get(packed, i + step)
    return F.coalesce(here.bitwiseAND(~_MASK) == there.bitwiseAND(~_MASK), F.lit(False))


def _clash(packed: Column, hashes: Column) -> Column:
    """Whether cutting the hashes made two different ones neighbours."""
    return F.exists(
        F.sequence(F.lit(1), F.size(hashes) - 1),
        lambda i: _same_head(packed, i, -1)
        & (F.get(hashes, _start(F.get(packed, i))) != F.get(hashes, _start(F.get(packed, i - 1)))),
    )


def _starts_of_packed(packed: Column) -> Column:
    repeated = F.filter(
        packed, lambda x, i: _same_head(packed, i, -1) | _same_head(packed, i, 1)
    )
    return F.transform(repeated, _start)


def _pairs(hashes: Column) -> Column:
    return F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))


def _starts_of_pairs(pairs: Column) -> Column:
    def same(x: Column, i: Column) -> Column:
        return F.coalesce(F.get(pairs, i)["h"] == x["h"], F.lit(False))

    repeated = F.filter(pairs, lambda x, i: same(x, i - 1) | same(x, i + 1))
    return F.transform(repeated, lambda x: x["i"])


def with_counts(docs: DataFrame) -> DataFrame:
    """``docs`` with the counts of ``COUNTS`` and ``n_lines``, the lines that hold a word."""
    text = text_or_empty(F.col("text"))
    none = F.array().cast("array<int>")
    rows = docs.drop(*COUNTS, "n_lines").withColumn("_words", words(F.col("text")))
    rows = rows.withColumns(
        {
            "_hashes": _window_hashes(F.col("_words")),
            "_lines": F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
            "n_symbols": F.length(F.regexp_replace(text, SYMBOLS, "")).cast("long"),
        }
    )
    hashes = F.col("_hashes")
    packed, pairs = F.col("_packed"), F.col("_pairs")
    repeats = F.size(F.array_distinct(hashes)) < F.size(hashes)
    rows = rows.withColumn("_packed", F.when(repeats, _packed(hashes)))
    inexact = (F.size(hashes) > _MASK) | _clash(packed, hashes)
    rows = rows.withColumn("_pairs", F.when(packed.isNotNull() & inexact, _pairs(hashes)))
    starts = F.sort_array(
        F.when(pairs.isNotNull(), _starts_of_pairs(pairs))
        .when(packed.isNotNull(), _starts_of_packed(packed))
        .otherwise(none)
    )
    covered = F.aggregate(
        starts,
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda done, at: F.struct(
            (at + WINDOW).alias("end"),
            (done["n"] + F.least(F.lit(WINDOW), at + WINDOW - done["end"])).alias("n"),
        ),
        lambda done: done["n"].cast("long"),
    )
    return rows.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": covered,
        }
    ).drop("_words", "_hashes", "_lines", "_packed", "_pairs")


def base_failed() -> Column:
    n = F.col("n_words")
    return (n < 50) | (100 * F.col("n_repeat_words") > 50 * n)


def _log_factorial(n: Column) -> Column:
    """Stirling's series, shifted by ten so that it holds to twelve digits from n = 0 on."""
    x = n.cast("double") + 11.0
    series = (
        (x - 0.5) * F.log(x)
        - x
        + 0.5 * math.log(2 * math.pi)
        + 1 / (12 * x)
        - 1 / (360 * x * x * x)
        + 1 / (1260 * x * x * x * x * x)
    )
    for k in range(1, 11):
        series = series - F.log(n.cast("double") + k)
    return series


def binomial_tail(k: Column, n: Column, share: float, terms: int = 20_000) -> Column:
    """P(X <= k) for X ~ Binomial(n, share), by its terms from k downwards.

    Below the mean each term is smaller than the one above it, by more with every step;
    ``terms`` of them reach fifteen standard deviations down for n up to 10**8.
    """
    log_odds = math.log(share) - math.log1p(-share)
    top = (
        _log_factorial(n)
        - _log_factorial(k)
        - _log_factorial(n - k)
        + k * math.log(share)
        + (n - k) * math.log1p(-share)
    )
    steps = F.sequence(F.lit(0).cast("long"), F.least(k, F.lit(terms).cast("long")))
    summed = F.aggregate(
        steps,
        F.struct(F.lit(0.0).alias("log"), F.lit(0.0).alias("sum")),
        lambda done, j: F.struct(
            # the term below k - j is (k - j) / (n - k + j + 1) / odds of the one at k - j
            (
                done["log"]
                + F.log(F.greatest(k - j, F.lit(0)).cast("double") / (n - k + j + 1))
                - log_odds
            ).alias("log"),
            (done["sum"] + F.exp(F.coalesce(done["log"], F.lit(float("-inf"))))).alias("sum"),
        ),
        lambda done: done["sum"],
    )
    return F.when(n == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.exp(top) * summed))


def _ratio(rule: Rule) -> Column:
    below = F.col(rule.denominator)
    return F.when(below > 0, F.col(rule.numerator) / below).otherwise(F.lit(0.0))


def thresholds(
    labelled: DataFrame,
    stratum: str,
    rules: tuple[Rule, ...] = RULES,
    risk: float = 0.05,
    error: float = 0.05,
    least_catch: float = 0.1,
) -> DataFrame:
    """One row per stratum: a cutoff for each rule, NULL where the rule is not used.

    ``labelled``: counted documents that passed the base rule, with ``quality`` 0 or 1.
    """
    tests = [(rule.name, cutoff) for rule in rules for cutoff in rule.cutoffs]
    good, bad = F.col("quality") == 1, F.col("quality") == 0
    sums = [F.count_if(good).alias("n_good"), F.count_if(bad).alias("n_bad")]
    by_name = {rule.name: rule for rule in rules}
    for i, (name, cutoff) in enumerate(tests):
        hit = _ratio(by_name[name]) >= cutoff
        sums += [F.count_if(good & hit).alias(f"g{i}"), F.count_if(bad & hit).alias(f"b{i}")]
    sums = keep(labelled.where(good | bad).groupBy(stratum).agg(*sums), "label-counts")
    strata = sums.count()
    each = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("rule"),
                    F.lit(cutoff).alias("cutoff"),
                    F.col(f"g{i}").alias("k_good"),
                    F.col(f"b{i}").alias("k_bad"),
                )
                for i, (name, cutoff) in enumerate(tests)
            ]
        )
    )
    rows = sums.select(stratum, "n_good", "n_bad", each.alias("t")).select(
        stratum, "n_good", "n_bad", "t.*"
    )
    level = error / (strata * len(tests)) if strata else 0.0
    shown = binomial_tail(F.col("k_good"), F.col("n_good"), risk / len(rules)) <= level
    caught = F.col("k_bad") / F.greatest(F.col("n_bad"), F.lit(1))
    admitted = rows.where(shown & (F.col("k_bad") > 0) & (caught >= least_catch))
    chosen = [
        F.max(F.when(F.col("rule") == rule.name, F.struct("k_bad", "cutoff")))["cutoff"].alias(
            rule.name
        )
        for rule in rules
    ]
    return admitted.groupBy(stratum).agg(*chosen)


def judge(
    docs: DataFrame,
    labels: DataFrame,
    stratum: str = "lang",
    rules: tuple[Rule, ...] = RULES,
    **control: float,
) -> DataFrame:
    """``docs`` with its counts, ``base_failed`` and ``kept``; counted once, into a kept table."""
    taken = ["base_failed", "kept"]
    counted = keep(with_counts(docs.drop(*taken)).withColumn("base_failed", base_failed()), "counted")
    truth = labels.select(F.col("doc_id").alias("_labelled"), F.col("quality").alias("quality"))
    narrow = counted.where(~F.col("base_failed")).select("doc_id", stratum, "n_lines", *COUNTS)
    labelled = narrow.join(truth, F.col("doc_id") == F.col("_labelled"))
    cutoffs = thresholds(labelled, stratum, rules, **control).withColumnsRenamed(
        {stratum: "_stratum"} | {rule.name: f"_at_{rule.name}" for rule in rules}
    )
    judged = counted.join(cutoffs, counted[stratum].eqNullSafe(cutoffs["_stratum"]), "left")
    rejected = F.lit(False)
    for rule in rules:
        rejected = rejected | F.coalesce(_ratio(rule) >= F.col(f"_at_{rule.name}"), F.lit(False))
    judged = judged.withColumn("kept", ~F.col("base_failed") & ~rejected)
    return judged.drop("_stratum", *[f"_at_{rule.name}" for rule in rules])
