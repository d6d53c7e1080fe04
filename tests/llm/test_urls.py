import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import urls
from tallyhouse.llm.queries import QUERIES


@pytest.mark.parametrize(
    ("url", "host", "path", "rule"),
    [
        ("https://A.Example.NET/en/1?x=/fr/", "a.example.net", "/en/1", "example.net/en/"),
        ("http://example.net/EN/1#y", "example.net", "/EN/1", "net/"),
        ("http://notexample.net/en/", "notexample.net", "/en/", "net/"),
        ("http://example.net", "example.net", "", None),
        ("x://y://example.org/fr/", "y:", "//example.org/fr/", None),
        ("ftp://EXAMPLE.com/de/?", "example.com", "/de/", "example.com/de/"),
        ("http://É.org/fr/a\nb", "É.org", "/fr/a\nb", "org/fr/"),
        ("no scheme", "", "", None),
        ("", "", "", None),
        (None, "", "", None),
    ],
)
def test_parts_and_rules(spark, url, host, path, rule):
    row = urls.with_rules(spark.createDataFrame([(1, url)], "page_id long, url string")).first()
    assert (row.host, row.path, row.rule) == (host, path, rule)


def test_held_out_accuracy(spark):
    """Spam has many digits and parameters; a fifth of the labels is held out."""
    rows = [(i, f"http://s{i % 7}.example.org/{i * 7919}{i * 104729}?a=1&b=2&c=3", 1) for i in range(400)]
    rows += [(5000, None, 1), (5001, "", 0)]
    rows += [(1000 + i, f"http://www.site{i % 9}.com/about/people/page", 0) for i in range(400)]
    pages = spark.createDataFrame(rows, "page_id long, url string, label int")
    held_out = F.pmod(F.xxhash64("url"), F.lit(5)) == 0
    judged = urls.judge(pages.where(held_out).drop("label"), pages.where(~held_out), rules=())
    wrong = judged.join(pages.select("page_id", "label"), "page_id").where(
        (F.col("verdict") == "block") != (F.col("label") == 1)
    )
    assert wrong.count() <= 0.02 * judged.count()


def test_copies_of_one_url_do_not_fill_the_sample(spark):
    """25,000 copies of a blocked URL, beside fifty allowed ones and fifty other blocked ones."""
    rows = [("http://spam.example.org/777?a=1&b=2", 1)] * 25_000
    rows += [(f"http://spam.example.org/{i * 7919}{i * 104729}?a=1&b=2", 1) for i in range(50)]
    rows += [(f"http://www.site{i % 5}.com/about/page{i}", 0) for i in range(50)]
    labelled = spark.createDataFrame(rows, "url string, label int")
    truth = urls.with_rules(labelled, ())
    model = urls.UrlModel(truth.select("url", "host", "path", "label"), most_training=60)
    assert model.trees is not None
    pages = spark.createDataFrame([("http://spam.example.org/123456789?a=3&b=4",), ("http://www.site2.com/about/us",)], "url string")
    found = urls.judge(pages, labelled, rules=(), most_training=60).orderBy("url").collect()
    assert [r.verdict for r in found] == ["block", "allow"]


def _brute_verdicts(rows, rules):
    """The rule's verdict for every URL that a rule fits, by plain string comparison."""
    found = {}
    for page_id, url in rows:
        head, mark, rest = (url or "").partition("://")
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[: min([len(rest), *[rest.find(x) for x in "/?#" if x in rest]])]) if mark else ""
        tail = rest[len(host) :] if mark else ""
        path = tail[: min([len(tail), *[tail.find(x) for x in "?#" if x in tail]])]
        fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fits, key=lambda r: len(r.pattern), default=None)
        found[page_id] = (host, path, best.pattern if best else None, best.verdict if best else None)
    return found


def test_the_query_on_the_test_tables(spark):
    """Rules against brute force; what no rule decides has one of the two verdicts."""
    folder = "/root/testdata/sf0.001"
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url").collect()
    wanted = _brute_verdicts(pages, urls.RULES)
    found = QUERIES["op4_url_filters"](spark, folder).collect()
    assert len(found) == len(pages)
    for row in found:
        host, path, rule, verdict = wanted[row.page_id]
        assert (row.host, row.path, row.rule) == (host, path, rule)
        assert row.verdict == verdict if verdict else row.verdict in ("allow", "block")


def test_odd_tables(spark):
    pages = spark.createDataFrame(
        [(1, None, "h"), (1, None, "h"), (None, "http://x.net/" + "a" * 100_000, "h")],
        "page_id long, url string, host string",
    )
    found = urls.judge(pages).orderBy("page_id").collect()
    assert [(r.page_id, r.host, r.verdict) for r in found] == [(None, "x.net", "block"), (1, "", "block"), (1, "", "block")]
    assert urls.judge(pages.where("page_id = 1")).where("verdict = 'allow'").count() == 2
    assert urls.judge(pages.limit(0)).count() == 0


def test_entropy(spark):
    df = spark.createDataFrame([("abab", 1.0), ("aaaa", 0.0), ("", 0.0), ("abcd", 2.0)], "t string, e double")
    assert df.where(F.abs(urls._entropy(F.col("t")) - F.col("e")) > 1e-12).count() == 0
