"""URL filters with DataFrame functions alone.

Host and path are cut from the url; the longest rule that fits decides. Urls that
no rule decides are judged by gradient-boosted trees over lexical features,
trained on a bounded sample of the urls that rules did label. The trees are
grown by Spark's own learner and then written out as one column expression, so
scoring is plain SQL.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subledger.llm.common import ascii_lower, cut, smallest_hashes


@dataclass(frozen=True)
class Rule:
    """Allows or blocks a host with all its subdomains below a path."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def parsed(urls: DataFrame, url_col: str = "url") -> DataFrame:
    """Add host and path (see the contract): the host ends at the first ``/``,
    ``?`` or ``#`` after ``://``, the path at the first ``?`` or ``#``; both are
    empty without ``://`` and for a null url."""
    at = F.instr(F.col(url_col), "://")
    rest = F.coalesce(F.when(at > 0, F.substr(F.col(url_col), at + 3)), F.lit(""))
    return urls.withColumn("host", ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1))).withColumn(
        "path", F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    )


def ruled(urls: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add rule (its name) and rule_verdict of the longest rule that fits host and
    path, else null."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):  # the last that fits wins
        host = (F.col("host") == rule.host) | F.endswith("host", F.lit("." + rule.host))
        fits = host & F.startswith("path", F.lit(rule.path))
        name, verdict = F.when(fits, rule.name).otherwise(name), F.when(fits, rule.verdict).otherwise(verdict)
    return urls.withColumn("rule", name).withColumn("rule_verdict", verdict)


#: Names of the lexical features, in the trees' order.
FEATURES = (
    "length", "host_length", "path_length", "depth", "labels", "digits", "digit_ratio", "entropy",
    "parameters", "query_length", "hyphens", "escapes", "longest_part", "tld_rate", "suffix_rate",
)


def _entropy(text: Column) -> Column:
    """Shannon entropy, in bits, of the characters of a text."""
    size = F.char_length(text).cast("double")

    def share(c: Column) -> Column:
        return (size - F.char_length(F.replace(text, c, F.lit("")))) / size

    return F.aggregate(F.array_distinct(F.split(text, "")), F.lit(0.0), lambda acc, c: F.when(c == "", acc).otherwise(acc - share(c) * F.log2(share(c))))


def with_features(urls: DataFrame, rates: DataFrame, url_col: str = "url") -> DataFrame:
    """Add the feature columns (prefix f_). ``rates`` are the suffix statistics:
    (suffix, rate); a suffix without labelled urls takes the overall rate, held
    under the empty suffix."""
    u = F.coalesce(F.col(url_col), F.lit(""))
    size = F.char_length(u).cast("double")
    digits = F.char_length(F.regexp_replace(u, "[^0-9]", "")).cast("double")
    query = F.regexp_extract(u, r"\?([^#]*)", 1)
    parts = F.split(F.col("path"), "/")
    columns = {
        "length": size,
        "host_length": F.char_length("host"),
        "path_length": F.char_length("path"),
        "depth": F.size(F.filter(parts, lambda p: p != "")),
        "labels": F.size(F.split("host", r"\.")),
        "digits": digits,
        "digit_ratio": F.when(size > 0, digits / size).otherwise(0.0),
        "entropy": _entropy(u),
        "parameters": F.when(query == "", 0).otherwise(F.size(F.split(query, "&"))),
        "query_length": F.char_length(query),
        "hyphens": F.char_length(F.regexp_replace(u, "[^-_]", "")),
        "escapes": F.char_length(F.regexp_replace(u, "[^%]", "")),
        "longest_part": F.array_max(F.transform(parts, lambda p: F.char_length(p))),
    }
    df = urls.withColumns({f"f_{k}": F.coalesce(c.cast("double"), F.lit(0.0)) for k, c in columns.items()})
    overall = rates.where("suffix = ''").select(F.max("rate").alias("f_overall"))
    df = df.withColumn("_tld", F.substring_index("host", ".", -1)).withColumn("_suffix", F.substring_index("host", ".", -2))
    # Two tables, for there are few top-level labels, some with a large share of all rows, and
    # as many pairs of labels as sites: the planner sees the size of each.
    last = cut(rates.where("suffix <> '' and instr(suffix, '.') = 0"), "tld-rates")
    pairs = cut(rates.where("instr(suffix, '.') > 0"), "pair-rates")
    for table, key, name in ((last, "_tld", "f_tld_rate"), (pairs, "_suffix", "f_suffix_rate")):
        df = df.join(table.select(F.col("suffix").alias(key), F.col("rate").alias(name)), key, "left")
    # A host of one label is its own last two.
    df = df.withColumn("f_suffix_rate", F.when(F.col("_suffix") == F.col("_tld"), F.col("f_tld_rate")).otherwise(F.col("f_suffix_rate")))
    whole = overall.first()["f_overall"]
    return df.fillna(0.5 if whole is None else whole, ["f_tld_rate", "f_suffix_rate"])


def suffix_rates(labelled: DataFrame, weight: float = 10.0) -> DataFrame:
    """(suffix, rate): by top-level label and by last two labels, the share of
    blocked urls, drawn towards the overall share (suffix '') as if ``weight``
    more urls had it. Counted over all labelled urls."""
    y = (F.col("rule_verdict") == "block").cast("int")
    each = labelled.select(
        y.alias("y"),
        F.explode(F.array_distinct(F.array(F.lit(""), F.substring_index("host", ".", -1), F.substring_index("host", ".", -2)))).alias("suffix"),
    )
    counts = cut(each.groupBy("suffix").agg(F.sum("y").alias("b"), F.count("*").alias("n")), "suffix-counts")
    first = counts.where("suffix = ''").first()
    prior = first["b"] / first["n"] if first else 0.5
    return cut(counts.select("suffix", ((F.col("b") + weight * prior) / (F.col("n") + weight)).alias("rate")), "suffix-rates")


def _tree(node) -> Column:
    """A regression tree (of the learner's JVM model) as a column expression."""
    if node.subtreeDepth() == 0:
        return F.lit(float(node.prediction()))
    split = node.split()
    goes_left = F.col("f_" + FEATURES[split.featureIndex()]) <= F.lit(float(split.threshold()))
    return F.when(goes_left, _tree(node.leftChild())).otherwise(_tree(node.rightChild()))


@dataclass(frozen=True)
class UrlModel:
    """Trees as an expression over the feature columns, and the suffix rates."""

    margin: Column
    rates: DataFrame

    def block_probability(self) -> Column:
        return 1.0 / (1.0 + F.exp(-2.0 * self.margin))


def train(labelled: DataFrame, sample: int = 20_000, trees: int = 20, depth: int = 4, seed: int = 11) -> UrlModel:
    """Boosted trees on at most ``sample`` distinct labelled urls (the smallest
    hashes). With labels of one class or none, the margin is constant: that
    class, or allow."""
    rates = suffix_rates(labelled)
    distinct = cut(labelled.select("url", "host", "path", "rule_verdict").distinct(), "labelled-urls")
    picked = cut(smallest_hashes(distinct, ["url"], sample), "url-sample")
    ready = cut(with_features(picked, rates).withColumn("y", (F.col("rule_verdict") == "block").cast("double")), "url-features")
    classes = {r["y"]: r["count"] for r in ready.groupBy("y").count().collect()}
    if len(classes) < 2:
        return UrlModel(F.lit(3.0 if 1.0 in classes else -3.0), rates)
    vectors = VectorAssembler(inputCols=["f_" + f for f in FEATURES], outputCol="x").transform(ready).select("x", "y")
    model = GBTClassifier(featuresCol="x", labelCol="y", maxIter=trees, maxDepth=depth, seed=seed).fit(vectors)
    margin = F.lit(0.0)
    for tree, weight in zip(model.trees, model.treeWeights, strict=True):
        margin = margin + F.lit(float(weight)) * _tree(tree._call_java("rootNode"))
    return UrlModel(margin, rates)


def filter_urls(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, block_probability.

    Null and malformed urls have an empty host and path, fit no rule and are
    judged by the trees. Rows that repeat stay; other columns are passed over.
    """
    rows = ruled(parsed(pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))), rules)
    model = train(rows.where(F.col("rule").isNotNull()))
    scored = with_features(rows, model.rates).withColumn("block_probability", model.block_probability())
    own = F.when(F.col("block_probability") > 0.5, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", own).alias("verdict"), "block_probability")
