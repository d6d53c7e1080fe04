"""URL verdicts: rules on host and path first, boosted trees on lexical features for the rest.

A rule is ``host/path``; it fits its host and all subdomains if the URL's path starts with the
rule's, and the longest fitting rule wins. URLs without one are judged by gradient-boosted trees
trained from labelled URLs. Features: length, depth, share of digits, entropy of the characters,
number of parameters, and statistics of the host's suffix (its last two labels) over all
labelled URLs: how many there are, and what share is blocked, smoothed towards the overall
share. For a URL used in training its own copies are left out of that share.

Trees are fitted on at most ``most_training`` different labelled URLs, up to half of them of each
label and of each the smallest by hash, so that each is as likely; a URL weighs as much as it has
copies. The statistics and verdicts cover all. Without labels of both kinds everything without a rule
gets the one label there is, or ``allow``.

Everything is DataFrame functions and Spark's own classifier.

Defined cases: a NULL URL, or one without ``://``, has an empty host and path and no rule;
repeated URLs are judged each and count each; very long URLs are ordinary.
"""

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.scratch import keep

FEATURES = [
    "_length",
    "_host_length",
    "_depth",
    "_digit_share",
    "_entropy",
    "_parameters",
    "_suffix_count",
    "_suffix_blocked",
]
_PRIOR = 20.0
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    pattern: str
    verdict: str

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.pattern.partition("/")[2]

    def fits(self, host: Column, path: Column) -> Column:
        own = (host == self.host) | host.endswith("." + self.host)
        return own & path.startswith(self.path)


#: Fixed values of the query's contract.
RULES = (
    Rule("net/", "block"),
    Rule("example.net/en/", "allow"),
    Rule("example.com/de/", "block"),
    Rule("org/fr/", "allow"),
)


def _part(url: Column, group: int) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", group), F.lit(""))


def with_rules(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``rule_verdict``."""
    host = F.translate(_part(F.col("url"), 1), _UPPER, _LOWER)
    rows = pages.withColumns({"host": host, "path": _part(F.col("url"), 2)})
    pattern, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.pattern)):
        fits = rule.fits(F.col("host"), F.col("path"))
        pattern = F.when(fits, rule.pattern).otherwise(pattern)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return rows.withColumns({"rule": pattern, "rule_verdict": verdict})


def _entropy(text: Column) -> Column:
    """In bits per character."""
    n = F.greatest(F.length(text), F.lit(1))
    zero = F.lit(0.0)

    def add(total: Column, c: Column) -> Column:
        share = (F.length(text) - F.length(F.replace(text, c, F.lit("")))) / n
        return total - F.when(share > 0, share * F.log2(share)).otherwise(zero)

    return F.aggregate(F.array_distinct(F.split(text, "")), zero, add)


def _lexical(pages: DataFrame) -> DataFrame:
    url = F.coalesce("url", F.lit(""))
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    n = F.greatest(F.length(url), F.lit(1))
    return pages.withColumns(
        {
            "_length": F.length(url).cast("double"),
            "_host_length": F.length("host").cast("double"),
            "_depth": F.size(F.array_remove(F.split("path", "/"), "")).cast("double"),
            "_digit_share": F.length(F.regexp_replace(url, r"[^0-9]+", "")) / n,
            "_entropy": _entropy(url),
            "_parameters": F.size(F.array_remove(F.split(query, "&"), "")).cast("double"),
            "_suffix": F.substring_index("host", ".", -2),
        }
    )


def _with_suffixes(
    rows: DataFrame, suffixes: DataFrame, overall: float, own: Column, own_blocked: Column
) -> DataFrame:
    """``own``: how many of the labels that the statistics count are the row's, ``own_blocked`` of these."""
    joined = rows.join(suffixes, "_suffix", "left")
    n = F.coalesce("_n", F.lit(0)) - own
    blocked = F.coalesce("_blocked", F.lit(0)) - own_blocked
    return joined.withColumns(
        {
            "_suffix_count": F.log1p(n.cast("double")),
            "_suffix_blocked": (blocked + _PRIOR * overall) / (n + _PRIOR),
        }
    )


def _copies(labelled: DataFrame) -> DataFrame:
    """Each different URL and label once, with its host, path and suffix and how many copies there are."""
    one = [F.first(c).alias(c) for c in ("host", "path")]
    copies = F.count(F.lit(1)).alias("_copies")
    rows = labelled.groupBy("url", "label").agg(*one, copies)
    return rows.withColumn("_suffix", F.substring_index("host", ".", -2))


class UrlModel:
    """Suffix statistics of all labelled URLs and trees fitted on a bounded sample."""

    def __init__(self, labelled: DataFrame, most_training: int = 20_000, trees: int = 20, depth: int = 4):
        """``labelled``: ``url``, ``host``, ``path`` and ``label``, 1 for block and 0 for allow."""
        rows = keep(_copies(labelled.where(F.col("label").isin(0, 1))), "labelled-urls")
        blocked = F.sum(F.col("label") * F.col("_copies")).alias("_blocked")
        self.suffixes = keep(
            rows.groupBy("_suffix").agg(F.sum("_copies").alias("_n"), blocked), "suffixes"
        )
        total = self.suffixes.agg(F.sum("_n").alias("n"), F.sum("_blocked").alias("blocked")).first()
        self.overall = total["blocked"] / total["n"] if total["n"] else 0.0
        self.trees = None
        if 0 < self.overall < 1:
            order = F.xxhash64("url"), "url"
            halves = [rows.where(F.col("label") == k).orderBy(*order).limit(most_training // 2) for k in (0, 1)]
            sample = _lexical(halves[0].unionByName(halves[1]).drop("_suffix"))
            own = F.col("_copies"), F.col("_copies") * F.col("label")
            sample = _with_suffixes(sample, self.suffixes, self.overall, *own)
            sample = keep(sample.select(*FEATURES, "label", F.col("_copies").cast("double").alias("_weight")), "training")
            gbt = GBTClassifier(
                featuresCol="_features",
                labelCol="label",
                weightCol="_weight",
                maxIter=trees,
                maxDepth=depth,
                seed=7,
            )
            in_order = sample.coalesce(1).sortWithinPartitions(*FEATURES, "label")
            self.trees = gbt.fit(_assembled(in_order))

    def verdicts(self, pages: DataFrame) -> DataFrame:
        """``pages`` with ``model_verdict``."""
        columns = [*pages.columns, "model_verdict"]
        rows = _lexical(pages)
        if self.trees is None:
            constant = "block" if self.overall > 0.5 else "allow"
            return rows.withColumn("model_verdict", F.lit(constant)).select(*columns)
        rows = _with_suffixes(rows, self.suffixes, self.overall, F.lit(0), F.lit(0))
        judged = self.trees.setPredictionCol("_predicted").transform(_assembled(rows))
        verdict = F.when(F.col("_predicted") > 0.5, "block").otherwise("allow")
        return judged.withColumn("model_verdict", verdict).select(*columns)


def _assembled(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="_features").transform(rows)


def judge(
    pages: DataFrame, labelled: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, **training: int
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    ``labelled``: ``url`` and ``label``; without it the URLs that rules decide are the labels.
    """
    own = ["host", "path", "rule", "rule_verdict", "model_verdict", "verdict"]
    judged = with_rules(pages.drop(*own), rules)
    if labelled is None:
        decided = F.when(F.col("rule_verdict") == "block", 1).when(F.col("rule_verdict") == "allow", 0)
        truth = with_rules(pages.select("url"), rules).withColumn("label", decided)
    else:
        truth = with_rules(labelled.select("url", "label"), rules)
    model = UrlModel(truth.select("url", "host", "path", "label"), **training)
    rows = model.verdicts(judged)
    verdict = F.coalesce("rule_verdict", "model_verdict")
    return rows.withColumn("verdict", verdict).drop("rule_verdict", "model_verdict")
