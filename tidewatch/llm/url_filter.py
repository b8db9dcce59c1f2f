"""URL filter: rules first, then gradient-boosted trees on lexical features.

Native: DataFrame functions and MLlib's trees only.

* Rules are (verdict, rule) with rule = host and path, such as ``example.org/es/``.
  A rule fits its host and all subdomains when the URL's path starts with the
  rule's; of several the longest wins (then the first). They are a parameter and
  become one CASE expression.
* Other URLs get the trees' verdict. The trees learn from labelled URLs; without
  others, the URLs that a rule decides are the labels.
* Features: lengths, depth, digit ratio, character entropy, parameter count, marks,
  and statistics of the host's suffix and of the path's first segment: their
  share of all URLs and the share of blocked ones among the labelled. The
  statistics are counted over all rows and kept for every suffix and segment.
  Those of 1 in 1,000 rows or more, so at most 1,000, are broadcast; all others
  reach their rows by an ordinary join, with the same values.
* The trees are fitted on at most ``sample`` labelled URLs, drawn by a hash of the
  URL (a URL that repeats counts once).

A null URL, or one without ``://``, has empty host and path, fits no rule, and gets the
trees' verdict on empty text. URLs that repeat are judged row by row. Without
labelled URLs every verdict is ``allow``; with labels of one kind, that kind. An
empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, sampled, written

SAMPLE = 20_000
TREES = 12
DEPTH = 4
SEED = 7
FEATURES = ["length", "host_length", "path_length", "depth", "labels", "digit_ratio", "entropy", "parameters", "marks", "fragment", "suffix_share", "suffix_blocked", "head_share", "head_blocked"]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return lower_ascii(host), path


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """Struct (verdict, rule) of the longest rule that fits, else null."""
    found = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in sorted(rules[::-1], key=lambda r: len(r[1])):  # the longest (of these the first) comes last and so stands outermost
        own_host, slash, own_path = rule.partition("/")
        fits = ((host == own_host) | host.endswith("." + own_host)) & path.startswith(slash + own_path)
        found = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(found)
    return found


def _count(c: Column, chars: str) -> Column:
    return F.length(c) - F.length(F.translate(c, chars, ""))


def lexical(df: DataFrame) -> DataFrame:
    """Features of columns url, host and path that need no statistics."""
    url = F.coalesce("url", F.lit(""))
    chars = F.split(url, "")
    share = lambda c: (F.length(url) - F.length(F.replace(url, c, F.lit("")))) / F.length(url)
    entropy = F.aggregate(F.array_distinct(chars), F.lit(0.0), lambda a, c: a - F.when(F.length(c) > 0, share(c) * F.log2(share(c))).otherwise(0.0))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    return df.withColumns({
        "length": F.length(url).cast("double"),
        "host_length": F.length("host").cast("double"),
        "path_length": F.length("path").cast("double"),
        "depth": _count(F.col("path"), "/").cast("double"),
        "labels": _count(F.col("host"), ".").cast("double"),
        "digit_ratio": _count(url, "0123456789") / F.greatest(F.length(url), F.lit(1)),
        "entropy": F.when(F.length(url) > 0, entropy).otherwise(0.0),
        "parameters": F.when(query == "", 0.0).otherwise((_count(query, "&") + 1).cast("double")),
        "marks": _count(url, "-_%~@").cast("double"),
        "fragment": F.contains(url, F.lit("#")).cast("double"),
        "suffix": F.substring_index("host", ".", -1),
        "head": F.lower(F.regexp_extract("path", r"^/*([^/]*)", 1)),
    })


def _with_statistics(df: DataFrame, key: str, total: int) -> DataFrame:
    """Adds the share of rows that have the row's ``key`` and the share of blocked
    ones among its labelled rows (smoothed by ten rows of the whole's share)."""
    counts = written(df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.count("label").alias("known"), F.coalesce(F.sum("label"), F.lit(0.0)).alias("bad")), f"url-{key}")
    all_known, all_bad = counts.agg(F.sum("known"), F.sum("bad")).first()
    prior = (all_bad + 1) / (all_known + 2)
    found = F.struct((F.col("n") / total).alias("share"), ((F.col("bad") + 10 * prior) / (F.col("known") + 10)).alias("blocked"))
    often = F.col("n") * 1000 >= total
    # Rows of a frequent key have their values already; a key of their own keeps them from meeting in the second join.
    df = df.join(F.broadcast(counts.where(often).select(key, found.alias("often"))), key, "left")
    rest = counts.where(~often).select(F.col(key).alias("rest_key"), found.alias("rest"))
    own = F.when(F.col("often").isNull(), F.concat(F.lit("="), key)).otherwise(F.concat(F.lit("-"), F.xxhash64("id", "url").cast("string")))
    df = df.withColumn("rest_key", own).join(rest.withColumn("rest_key", F.concat(F.lit("="), "rest_key")), "rest_key", "left")
    one = F.coalesce("often", "rest")
    return df.withColumns({f"{key}_share": one["share"], f"{key}_blocked": one["blocked"]}).drop("often", "rest", "rest_key")


def judge(pages: DataFrame, rules: list[tuple[str, str]], *, id_col: str = "page_id", url_col: str = "url", labels: Column | None = None, sample: int = SAMPLE) -> DataFrame:
    """Per row: id, host, path, rule, verdict, and the trees' own verdict (``model``).

    ``labels``: column of ``pages`` with 1 for blocked and 0 for allowed URLs, null
    for unknown; by default the rules' verdicts."""
    host, path = host_and_path(F.col("url"))
    own = F.lit(None).cast("double") if labels is None else labels.cast("double")
    df = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), own.alias("given"))
    df = df.withColumns({"host": host, "path": path}).withColumn("hit", rule_of(F.col("host"), F.col("path"), rules))
    label = F.col("given") if labels is not None else F.when(F.col("hit.verdict") == "block", 1.0).when(F.col("hit.verdict") == "allow", 0.0)
    df = lexical(df).withColumn("label", label)

    total, known, bad, urls = df.agg(F.count(F.lit(1)), F.count("label"), F.sum("label"), F.approx_count_distinct(F.when(F.col("label").isNotNull(), F.col("url")))).first()
    out = [F.col("id").alias(id_col), "host", "path", F.col("hit.rule").alias("rule")]
    if not known or bad in (0.0, float(known)):
        model = F.lit("block" if known and bad else "allow")
        return df.select(*out, F.coalesce("hit.verdict", model).alias("verdict"), model.alias("model"))

    for key in ("suffix", "head"):
        df = _with_statistics(df, key, total)
    labelled = df.where("label IS NOT NULL").select(F.coalesce("url", F.lit("")).alias("url"), "label", *FEATURES)
    drawn = written(sampled(labelled, "url", urls, sample).select("label", *FEATURES), "url-sample")
    kinds = drawn.agg(F.min("label"), F.max("label")).first()
    if kinds[0] is None or kinds[0] == kinds[1]:
        model = F.lit("block" if 2 * bad > known else "allow")
        return df.select(*out, F.coalesce("hit.verdict", model).alias("verdict"), model.alias("model"))
    vector = VectorAssembler(inputCols=FEATURES, outputCol="features")
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, maxBins=32, seed=SEED).fit(vector.transform(drawn))
    model = F.when(F.col("prediction") == 1.0, "block").otherwise("allow")
    return trees.transform(vector.transform(df)).select(*out, F.coalesce("hit.verdict", model).alias("verdict"), model.alias("model"))
