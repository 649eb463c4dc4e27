"""URL verdicts: host and path rules first, boosted trees on lexical features for the rest.

The URLs that a rule decides are the labelled ones; gradient-boosted trees learn
from a bounded sample of them and judge all others. Everything is DataFrame
functions and Spark's own tree learner.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsframe.llm.batches import hash_share
from opsframe.sources.scratch import written

#: Labelled URLs the trees learn from, at most.
TRAIN_ROWS = 20_000
#: Parts of the labelled URLs; a suffix's statistics leave out the part of the row that learns.
FOLDS = 5
TREES = 10
DEPTH = 4
SEED = 9
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class Rule:
    """Fits a host with its subdomains and every path that starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules that verdicts are compared by.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)
FEATURES = (
    "length", "host_length", "path_length", "host_labels", "depth", "digit_ratio",
    "host_digits", "hyphens", "entropy", "parameters", "fragment", "suffix_rate", "suffix_share",
)


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?`` or ``#``, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, URL, 1), UPPER, UPPER.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``; else empty."""
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Struct of the longest fitting rule's ``name`` and ``verdict``, null if none fits."""
    fits = [
        F.when(
            ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path),
            F.struct(
                F.lit(len(rule.name)).alias("n"),
                F.lit(rule.name).alias("name"),
                F.lit(rule.verdict).alias("verdict"),
            ),
        )
        for rule in rules
    ]
    return F.array_max(F.array(*fits)) if fits else F.lit(None).cast("struct<n:int,name:string,verdict:string>")


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


def entropy(text: Column) -> Column:
    """Bits per character of the text's own characters; zero if empty."""
    chars = F.split(text, "")
    n = F.length(text).cast("double")
    times = F.transform(
        F.array_distinct(chars), lambda c: F.length(text) - F.length(F.replace(text, c, F.lit("")))
    )
    bits = F.aggregate(
        F.filter(times, lambda k: k > 0), F.lit(0.0), lambda sum_, k: sum_ - k / n * F.log2(k / n)
    )
    return F.when(n > 0, bits).otherwise(0.0)


def suffix_of(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def lexical(urls: DataFrame) -> DataFrame:
    """The frame (columns url, host, path) with every lexical feature as a double."""
    url = F.coalesce(F.col("url"), F.lit(""))
    host, path = F.col("host"), F.col("path")
    return urls.withColumns(
        {
            "length": F.length(url).cast("double"),
            "host_length": F.length(host).cast("double"),
            "path_length": F.length(path).cast("double"),
            "host_labels": _count(host, r"[^.]+"),
            "depth": _count(path, r"/[^/]"),
            "digit_ratio": _share(_count(url, "[0-9]"), F.length(url)),
            "host_digits": _count(host, "[0-9]"),
            "hyphens": _count(host, "-"),
            "entropy": entropy(url),
            "parameters": _count(url, "[?&][^=&#]+="),
            "fragment": url.contains("#").cast("double"),
            "suffix": suffix_of(host),
        }
    )


def fold_of(url: Column, seed: int = SEED) -> Column:
    """The part of a labelled URL, the same for all its copies."""
    return F.pmod(F.xxhash64(F.lit(seed + 1), url), F.lit(FOLDS)).cast("int")


def _rates(bad: Column, n: Column, all_bad: Column | float, all_n: Column | float) -> list[Column]:
    """The smoothed share of blocked URLs of a suffix, and its share of all labelled ones."""
    usual = _share(F.lit(all_bad) if isinstance(all_bad, float) else all_bad, F.lit(all_n))
    return [((bad + 10 * usual) / (n + 10)).alias("suffix_rate"), _share(n, F.lit(all_n)).alias("suffix_share")]


class SuffixStatistics:
    """Blocked and all labelled URLs (suffix, fold, label) per suffix and fold.

    ``usual`` is the share of blocked ones among all of them, zero if there are none.
    """

    def __init__(self, labelled: DataFrame) -> None:
        self.per = written(
            labelled.groupBy("suffix", "fold").agg(F.sum("label").alias("bad"), F.count("*").alias("n")),
            "suffixes",
        )
        folds = {r["fold"]: (r["bad"], float(r["n"])) for r in self._folds().collect()}
        self.folds = [folds.get(fold, (0.0, 0.0)) for fold in range(FOLDS)]
        self.bad, self.n = (sum(x) for x in zip(*self.folds, strict=True))
        self.usual = self.bad / self.n if self.n else 0.0

    def _folds(self) -> DataFrame:
        return self.per.groupBy("fold").agg(F.sum("bad").alias("bad"), F.sum("n").alias("n"))

    def _by_suffix(self) -> DataFrame:
        every = self.per.groupBy("suffix").agg(F.sum("bad").alias("bad"), F.sum("n").alias("n"))
        return every.withColumnRenamed("suffix", "__suffix")

    def joined(self, urls: DataFrame) -> DataFrame:
        """The URLs with the statistics of all labelled ones."""
        per = self._by_suffix().select("__suffix", *_rates(F.col("bad"), F.col("n"), self.bad, self.n))
        return (
            urls.join(per, F.col("suffix") == F.col("__suffix"), "left")
            .drop("__suffix")
            .fillna({"suffix_rate": self.usual, "suffix_share": 0.0})
        )

    def joined_apart(self, labelled: DataFrame) -> DataFrame:
        """The labelled URLs, each with the statistics of those of all other folds.

        So no URL's own label, nor that of a copy, is in what it learns from.
        """
        rest = [(self.bad - bad, self.n - n) for bad, n in self.folds]
        all_bad, all_n = (
            F.element_at(F.array(*[F.lit(float(x)) for x in column]), F.col("__fold") + 1)
            for column in zip(*rest, strict=True)
        )
        own = self.per.select(F.col("suffix").alias("__s"), F.col("fold").alias("__fold"), "bad", "n")
        every = self._by_suffix().withColumnsRenamed({"bad": "__bad", "n": "__n"})
        per = own.join(every, F.col("__s") == F.col("__suffix")).select(
            "__s", "__fold", *_rates(F.col("__bad") - F.col("bad"), F.col("__n") - F.col("n"), all_bad, all_n)
        )
        same = (F.col("suffix") == F.col("__s")) & (F.col("fold") == F.col("__fold"))
        return labelled.join(per, same).drop("__s", "__fold")


def _drawn(labelled: DataFrame, n: int, seed: int) -> DataFrame:
    """The bounded sample of labelled rows that come first by a seeded hash of ``__key``."""
    keyed = labelled.withColumn("__h", F.xxhash64(F.lit(seed), "url", "__key"))
    # Only this share leaves the tasks.
    some = keyed.where(hash_share(F.col("__h"), TRAIN_ROWS, n))
    return some.orderBy("__h", "url", "__key").limit(TRAIN_ROWS)


def trained(sample: DataFrame, seed: int = SEED) -> GBTClassificationModel:
    """Trees on stored rows of the label and every feature."""
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(sample)
    return GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=seed, stepSize=0.3).fit(rows)


def _scored(urls: DataFrame, model: GBTClassificationModel) -> DataFrame:
    """The URLs with ``score``, the model's probability that they are blocked."""
    model = model.setRawPredictionCol("").setPredictionCol("__guess").setProbabilityCol("__p")
    ready = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(urls)
    return model.transform(ready).withColumn("score", vector_to_array(F.col("__p"))[1])


def _labelled(urls: DataFrame) -> DataFrame:
    """The URLs that a rule decides, with ``label`` (1 if blocked) and ``fold``."""
    blocked = (F.col("__fit.verdict") == "block").cast("double")
    return urls.where("__fit is not null").withColumns({"label": blocked, "fold": fold_of(F.col("url"))})


def held_out(
    pages: DataFrame, rules: tuple[Rule, ...] = RULES, url_col: str = "url", fold: int = 0
) -> DataFrame:
    """How trees that learn from the labelled URLs of the other folds judge one fold's.

    One row per label and verdict: ``label``, ``predicted`` (0 or 1) and ``n``.
    Statistics of suffixes come from the other folds too. Without labelled URLs
    of both kinds there is nothing to measure: no row.
    """
    url = F.col(url_col)
    urls = lexical(
        pages.select(
            url.alias("url"),
            host_of(url).alias("host"),
            path_of(url).alias("path"),
            F.xxhash64(F.lit(0), *(c for c in pages.columns if _plain(pages, c))).alias("__key"),
        )
    ).withColumn("__fit", rule_of(F.col("host"), F.col("path"), rules))
    labelled = _labelled(urls)
    rest = labelled.where(F.col("fold") != fold)
    statistics = SuffixStatistics(rest)
    schema = "label int, predicted int, n long"
    if not 0 < statistics.usual < 1:
        return pages.sparkSession.createDataFrame([], schema)
    sample = _drawn(statistics.joined_apart(rest), int(statistics.n), SEED)
    model = trained(written(sample.select("label", *FEATURES), "urls"))
    tested = _scored(statistics.joined(labelled.where(F.col("fold") == fold)), model)
    return tested.groupBy(
        F.col("label").cast("int").alias("label"), (F.col("score") >= 0.5).cast("int").alias("predicted")
    ).agg(F.count("*").alias("n"))


def _plain(frame: DataFrame, column: str) -> bool:
    return isinstance(frame.schema[column].dataType, T.AtomicType)


def judged(pages: DataFrame, rules: tuple[Rule, ...] = RULES, url_col: str = "url") -> DataFrame:
    """``pages`` with host, path, ``rule`` (null if none fits), ``score`` and ``verdict``.

    The longest fitting rule decides; else the trees do, and block from a score
    of a half. A null URL, or one without ``://``, has an empty host and path,
    which no rule fits; the trees judge it as they do any other. Rules that
    label no URL, or all alike, leave nothing to learn: the score is then the
    share of blocked ones, zero without any. Rows stay as they are; columns of
    these names that were there are replaced.
    """
    names = ("host", "path", "rule", "score", "verdict")
    kept = [c for c in pages.columns if c not in names]
    url = F.col(f"__row.{url_col}")
    urls = lexical(
        pages.select(F.struct(*kept).alias("__row")).select(
            "__row",
            url.alias("url"),
            host_of(url).alias("host"),
            path_of(url).alias("path"),
        )
    ).withColumn("__fit", rule_of(F.col("host"), F.col("path"), rules))
    # Rows of one URL are drawn each by itself, told apart by their other plain columns.
    key = F.xxhash64(F.lit(0), *(F.col("__row").getField(c) for c in kept if _plain(pages, c)))
    labelled = _labelled(urls.withColumn("__key", key).drop("__row"))
    statistics = SuffixStatistics(labelled)
    all_urls = statistics.joined(urls)
    if 0 < statistics.usual < 1:
        sample = _drawn(statistics.joined_apart(labelled), int(statistics.n), SEED)
        guess = _scored(all_urls, trained(written(sample.select("label", *FEATURES), "urls")))
    else:
        guess = all_urls.withColumn("score", F.lit(statistics.usual))
    verdict = F.coalesce(
        F.col("__fit.verdict"), F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    )
    return guess.select(
        "__row.*", "host", "path", F.col("__fit.name").alias("rule"), "score", verdict.alias("verdict")
    )
