"""URL filter: host and path rules, and boosted trees on lexical features for what no rule decides.

The trees are trained on the URLs that a rule decides (block 1, allow 0). Features look at the form of
the URL only: lengths, depth, digits, entropy, parameters, and what is known of the host's suffix (how common it is, and
the smoothed share of blocked URLs among its labelled ones). All of it is DataFrame functions and
Spark ML; suffix statistics cover all rows, and the fit uses the ``FIT_ROWS`` labelled rows
that come first by a hash of the URL.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import cut

#: The rules (fixed values): verdict, host, path.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
#: Labelled rows of the fit; trees, their depth and step; weight of the prior in a suffix's share.
FIT_ROWS = 20_000
TREES, DEPTH, STEP, SEED = 12, 4, 0.3, 7
PRIOR_ROWS = 20.0
BLOCK_AT = 0.5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = (
    "url_length host_length path_length query_length depth labels digit_ratio letter_ratio entropy n_params n_hyphens n_escapes "
    "longest_number has_fragment file_ending suffix_share suffix_blocked"
).split()


def with_parts(pages: DataFrame) -> DataFrame:
    """Add ``host`` and ``path``; both empty for a null url or one without ``://``."""
    url = F.coalesce(F.col("url"), F.lit(""))
    at = F.instr(url, "://")
    after = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    return pages.withColumns(
        {"host": F.translate(F.regexp_extract(after, r"^[^/?#]*", 0), _UPPER, _LOWER), "path": F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)}
    )


def _rule() -> tuple[Column, Column]:
    """Rule string and verdict of the longest rule that fits, else null."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for action, host, path in sorted(RULES, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule, verdict = F.when(fits, host + path).otherwise(rule), F.when(fits, action).otherwise(verdict)
    return rule, verdict


def with_features(pages: DataFrame) -> DataFrame:
    """Lexical features of ``url``, ``host`` and ``path`` (all 0 for an empty url)."""
    url = F.coalesce(F.col("url"), F.lit(""))
    size = F.greatest(F.length(url), F.lit(1)).cast("double")
    kept = lambda pattern: F.length(F.regexp_replace(url, pattern, "")).cast("double")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    letters = F.array_distinct(F.split(url, ""))
    shares = F.transform(letters, lambda c: (F.length(url) - F.length(F.replace(url, c, F.lit("")))) / size)
    entropy = F.aggregate(shares, F.lit(0.0), lambda total, p: total - F.when(p > 0, p * F.log2(p)).otherwise(0.0))
    numbers = F.transform(F.regexp_extract_all(url, F.lit(r"[0-9]+"), F.lit(0)), F.length)
    count = lambda column, c: F.length(column) - F.length(F.replace(column, F.lit(c), F.lit("")))
    columns = {
        "url_length": F.length(url),
        "host_length": F.length("host"),
        "path_length": F.length("path"),
        "query_length": F.length(query),
        "depth": count(F.col("path"), "/"),
        "labels": count(F.col("host"), "."),
        "digit_ratio": kept(r"[^0-9]") / size,
        "letter_ratio": kept(r"[^A-Za-z]") / size,
        "entropy": F.coalesce(entropy, F.lit(0.0)),
        "n_params": F.when(F.length(query) > 0, count(query, "&") + 1).otherwise(0),
        "n_hyphens": count(url, "-"),
        "n_escapes": count(url, "%"),
        "longest_number": F.coalesce(F.array_max(numbers), F.lit(0)),
        "has_fragment": F.contains(url, F.lit("#")).cast("int"),
        "file_ending": F.col("path").rlike(r"\.[A-Za-z0-9]{1,5}$").cast("int"),
        "suffix": F.substring_index("host", ".", -1),
    }
    return pages.withColumns({k: v if k == "suffix" else v.cast("double") for k, v in columns.items()})


def suffix_statistics(pages: DataFrame) -> DataFrame:
    """``(suffix, suffix_share, suffix_blocked)`` over all rows; pre-added per task."""
    counted = pages.groupBy("suffix").agg(F.count("*").alias("n"), F.count("rule_verdict").alias("labelled"), F.count(F.when(F.col("rule_verdict") == "block", 1)).alias("blocked"))
    total = pages.agg(F.count("*").alias("n"), F.count("rule_verdict").alias("labelled"), F.count(F.when(F.col("rule_verdict") == "block", 1)).alias("blocked")).first()
    prior = (total["blocked"] + 1) / (total["labelled"] + 2)
    return counted.select("suffix", (F.col("n") / max(total["n"], 1)).alias("suffix_share"), ((F.col("blocked") + PRIOR_ROWS * prior) / (F.col("labelled") + PRIOR_ROWS)).alias("suffix_blocked"))


def _assembled(pages: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(pages)


def fit(pages: DataFrame) -> GBTClassificationModel | None:
    """Trees on the different labelled URLs, weighted by their rows; None unless both labels occur.

    Beyond ``FIT_ROWS`` URLs those with the least hashes are taken, about that many.
    """
    labelled = pages.filter(F.col("rule_verdict").isNotNull()).withColumn("label", (F.col("rule_verdict") == "block").cast("double"))
    urls = labelled.groupBy("url").agg(F.count("*").cast("double").alias("weight"), *(F.first(c).alias(c) for c in ("label", *FEATURES)))
    urls = cut(urls.select("url", "label", "weight", *FEATURES), "url-labelled")
    share = FIT_ROWS / max(urls.count(), 1)
    sample = cut(urls.filter(F.pmod(F.xxhash64("url"), F.lit(1 << 30)) < int(min(share, 1.0) * (1 << 30))).drop("url"), "url-sample")
    if sample.select("label").distinct().count() < 2:
        return None
    # One partition for each few thousand rows of the bounded sample, whatever the cluster is set to.
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=SEED, maxBins=32, weightCol="weight")
    return trees.fit(_assembled(sample).select("label", "weight", "features").coalesce(4))


def judge(pages: DataFrame) -> DataFrame:
    """``(page_id, host, path, rule, verdict, score)``, one row per input row; ``score``: the trees' probability to block.

    Null and odd URLs have empty parts, fit no rule and are judged by the trees. Without labelled URLs of both kinds the trees
    are left out: score 0, verdict allow. Ids are passed on, null or repeated. Empty table: empty result. Other columns are ignored.
    """
    own = with_parts(pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url")))
    rule, verdict = _rule()
    own = with_features(own.withColumns({"rule": rule, "rule_verdict": verdict}))
    known = own.join(suffix_statistics(own), "suffix")
    model = fit(known)
    if model is None:
        scored = known.withColumn("score", F.lit(0.0))
    else:
        scored = model.transform(_assembled(known)).withColumn("score", vector_to_array("probability")[1])
    return scored.select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", F.when(F.col("score") >= BLOCK_AT, "block").otherwise("allow")).alias("verdict"), "score")
