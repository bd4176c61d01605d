"""URL filter: host and path rules first, then a logistic regression on hashed
character n-grams of host and path.

Everything here is DataFrame expressions and spark.ml: no Python runs on the
executors.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GRAMS = (3, 4)
FEATURES = 1 << 14
# Labelled URLs a model is fitted on at most. A larger table is a mistake.
MOST_LABELS = 100_000


@dataclass(frozen=True)
class Rule:
    """``verdict`` for urls whose host is ``host`` or below it and whose path
    starts with ``path``."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased. Path: from there up to ``?``, ``#`` or the end. Both are empty
    for null and for text without ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"\A[^/?#]*", 0)
    path = F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def matching_rule(host: Column, path: Column, rules: list[Rule], field: str) -> Column:
    """``name`` or ``verdict`` of the longest rule that fits, else null; of
    equally long ones the first listed."""
    out = F.lit(None).cast("string")
    # The longest is asked first: it ends up outermost.
    for rule in reversed(sorted(rules, key=lambda r: -len(r.name))):
        below = F.endswith(host, F.lit("." + rule.host)) | (host == rule.host)
        fits = below & F.startswith(path, F.lit(rule.path))
        out = F.when(fits, F.lit(getattr(rule, field))).otherwise(out)
    return out


def grams(padded: dict[str, Column], sizes: tuple[int, ...] = GRAMS) -> Column:
    """Character n-grams of columns by mark; each gram carries the mark. Text
    shorter than n gives one gram, the whole."""

    def of(text: Column, mark: str, n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.length(text) - n + 1, F.lit(1)))
        return F.transform(starts, lambda i: F.concat(F.lit(mark), F.substring(text, i, F.lit(n))))

    return F.concat(*[of(text, mark, n) for mark, text in padded.items() for n in sizes])


def featured(urls: DataFrame, url: str, features: str) -> DataFrame:
    host, path = host_and_path(F.col(url))
    # Columns of their own: inside the gram expressions they would be built anew per gram.
    rows = urls.withColumn(features + "h", F.concat(F.lit("^"), host, F.lit("$")))
    rows = rows.withColumn(features + "p", F.concat(F.lit("^"), path, F.lit("$")))
    marked = {"h": F.col(features + "h"), "p": F.col(features + "p")}
    hashed = HashingTF(inputCol=features + "g", outputCol=features, numFeatures=FEATURES, binary=True)
    return hashed.transform(rows.withColumn(features + "g", grams(marked)))


def fit(labelled: DataFrame, url: str = "url", blocked: str = "blocked", ridge: float = 0.01) -> LogisticRegressionModel:
    """Fit on a small table of urls and 0/1 labels. Rows with a null label are
    left out; a null url counts as empty."""
    rows = labelled.select(F.col(url).alias("url"), F.col(blocked).cast("double").alias("label")).na.drop(subset=["label"])
    if rows.limit(MOST_LABELS + 1).count() > MOST_LABELS:
        raise ValueError(f"more than {MOST_LABELS} labelled urls")
    model = LogisticRegression(featuresCol="features", labelCol="label", regParam=ridge, standardization=False)
    return model.fit(featured(rows, "url", "features").coalesce(1))


def judge(
    pages: DataFrame, rules: list[Rule], model: LogisticRegressionModel, url: str = "url", threshold: float = 0.5
) -> DataFrame:
    """``pages`` with host, path, rule, verdict and blocked_score.

    The longest fitting rule decides; without one a score of ``threshold`` or
    more blocks. Null urls and urls without ``://`` have empty host and path
    and are judged like any other. Rows are judged one by one, so repeated rows
    repeat; columns of these names in ``pages`` are replaced.
    """
    outputs = ("host", "path", "rule", "verdict", "blocked_score")
    keep = [c for c in pages.columns if c.lower() not in outputs]
    packed = pages.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(url).alias("url"))
    host, path = host_and_path(F.col("url"))
    scored = model.setProbabilityCol("p").transform(featured(packed, "url", "features"))
    score = vector_to_array("p")[1]
    own = F.when(score >= threshold, "block").otherwise("allow")
    return scored.select(
        "row.*",
        host.alias("host"),
        path.alias("path"),
        matching_rule(host, path, rules, "name").alias("rule"),
        F.coalesce(matching_rule(host, path, rules, "verdict"), own).alias("verdict"),
        score.alias("blocked_score"),
    )
