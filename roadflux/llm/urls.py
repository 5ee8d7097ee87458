"""URL filter: rules by host and path, and logistic regression on hashed character n-grams for all other URLs.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: from there up to ``?``, ``#`` or the
end; both empty for null or no ``://``. A rule fits its host and all subdomains if the path starts with the rule's; the longest
fitting rule wins (of equally long ones the first in code point order of host and path together, of equal ones the first given).

The classifier learns from a small labelled table (url, verdict): of a larger one, the ``MOST_LABELLED`` URLs with the smallest hash. Its
features are the 2-, 3- and 4-grams of host and path, hashed to ``BUCKETS``. Without labelled URLs everything else is allowed;
with one verdict among them, everything else has that verdict.

Empty tables give empty results. Extra columns pass through; columns named like the added ones are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from roadflux import workspace
from roadflux.llm.samples import smallest

# Rules as (host, path, verdict).
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
BUCKETS = 1 << 14
MOST_LABELLED = 4000
GRAMS = (2, 3, 4)


def host_and_path(url: Column) -> tuple[Column, Column]:
    after = F.coalesce(F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))), F.lit(""))
    host = F.translate(F.regexp_extract(after, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The winning rule (host and path) and its verdict, null where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # the best last, so that it decides
    for own_host, own_path, own_verdict in reversed(sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[0] + r[1]))):
        fits = ((host == own_host) | F.endswith(host, F.lit("." + own_host))) & F.startswith(path, F.lit(own_path))
        name = F.when(fits, own_host + own_path).otherwise(name)
        verdict = F.when(fits, own_verdict).otherwise(verdict)
    return name, verdict


def _features(frame: DataFrame) -> DataFrame:
    """Adds the column features, from host and path."""
    text = F.concat(F.lit("^"), F.col("host"), F.lit(" "), F.col("path"), F.lit("$"))

    def grams_of(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(text) - (n - 1)))
        return F.transform(starts, lambda at: F.substring(text, at, F.lit(n)))

    grams = F.concat(*[grams_of(n) for n in GRAMS])
    return HashingTF(inputCol="grams", outputCol="features", numFeatures=BUCKETS, binary=True).transform(frame.withColumn("grams", grams))


def _split(urls: DataFrame, url_col: str) -> DataFrame:
    host, path = host_and_path(F.col(url_col))
    return urls.withColumns({"host": host, "path": path})


def judge(pages: DataFrame, labelled: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, url_col: str = "url") -> DataFrame:
    """All columns, plus host, path, rule and verdict. labelled: (url, verdict). Without rules the method decides all."""
    pages = pages.drop(*[c for c in ("host", "path", "rule", "verdict") if c in pages.columns])
    names = pages.columns
    inner = [f"c{i}" for i in range(len(names))]  # no column of the caller can clash with one made here
    known = labelled.select("url", "verdict").where(F.col("url").isNotNull() & F.col("verdict").isin("allow", "block")).distinct()
    known = workspace.written(smallest(known, F.xxhash64("url"), MOST_LABELLED, known.count(), "url", "verdict"), "labelled-urls")
    verdicts = sorted(r.verdict for r in known.select("verdict").distinct().collect())
    split = _split(pages.toDF(*inner), f"c{names.index(url_col)}")
    if len(verdicts) < 2:
        guessed = split.withColumn("guess", F.lit(verdicts[0] if verdicts else "allow"))
    else:
        # one partition in a fixed order: the fitted weights are the same in every run
        table = _features(_split(known, "url")).withColumn("block", (F.col("verdict") == "block").cast("double")).select(
            "url", "features", "block").repartition(1).sortWithinPartitions("url")
        model = LogisticRegression(featuresCol="features", labelCol="block", regParam=0.01, maxIter=50, probabilityCol="chance",
                                   rawPredictionCol="raw", predictionCol="likelier").fit(table)
        guessed = model.transform(_features(split)).withColumn("guess", F.when(vector_to_array("chance")[1] >= 0.5, "block").otherwise("allow"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    done = guessed.select(*inner, "host", "path", name.alias("rule"), F.coalesce(verdict, F.col("guess")).alias("verdict"))
    return done.toDF(*names, "host", "path", "rule", "verdict")


def decided_by_rules(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, url_col: str = "url") -> DataFrame:
    """A labelled table (url, verdict) from the URLs that a rule decides."""
    split = _split(pages.select(F.col(url_col).alias("url")), "url")
    _, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return split.select("url", verdict.alias("verdict")).where(F.col("verdict").isNotNull())
