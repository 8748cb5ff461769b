"""Quality rules: fixed base rules, then robust multivariate outliers by minimum-covariance-determinant estimates.

Each document that passes the base rules has a vector of transformed statistics. For every language and source, the
centre and the covariance are those of the SUPPORT share of vectors with the least determinant, found by
concentration steps (estimate, keep the nearest share, estimate again) from two starts; a last step takes in all
vectors within the 0.975 quantile. A document is rejected when its squared Mahalanobis distance exceeds CUT.

All steps are aggregations that combine before the shuffle, over one small saved table of statistics: a source with a
third of all rows costs no more than others, and no rows are sampled. One row per group goes through numpy.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwatch.llm import octets
from millwatch.llm.store import map_arrow, octets_of, saved, small
from millwatch.llm.text_stats import NAMES, counts_of

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Share of a group's vectors that the determinant is taken of; up to as many may be outliers.
SUPPORT = 0.5
STEPS = 5
#: A group of fewer rows takes the estimate of its language, and that of the whole table if its language has too few.
LEAST_ROWS = 60
#: Chance that a normal vector is rejected. Real statistics have heavier tails, so it is far below the usual 0.025.
REJECT = 1e-9
#: The transformed statistics, and the least standard deviation that each is taken to have. A statistic that is zero
#: in most texts has no spread of its own; without a floor any other value would be infinitely far away.
VECTOR = {"x0": ("log mean word length", 0.05), "x1": ("log(1 + symbols per word)", 0.02), "x2": ("share of repeated lines", 0.10), "x3": ("share of repeated words", 0.10)}
_X = list(VECTOR)
_P = len(_X)
_FLOOR = np.diag([s * s for _, s in VECTOR.values()])
_PAIRS = [(i, j) for i in range(_P) for j in range(i, _P)]


def _below(x: float, p: int) -> float:
    """Chi-square distribution function for an even number p of degrees of freedom."""
    half, term, total = x / 2, 1.0, 1.0
    for k in range(1, p // 2):
        term *= half / k
        total += term
    return 1 - math.exp(-half) * total


def quantile(share: float, p: int = _P) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if _below(mid, p) < share else (low, mid)
    return high


#: Squared distance beyond which a document is rejected; from the upper tail, which is exact for small chances.
def cut(chance: float = REJECT) -> float:
    low, high = 0.0, 2000.0
    for _ in range(200):
        mid = (low + high) / 2
        tail = math.exp(-mid / 2) * (1 + mid / 2)
        low, high = (mid, high) if tail > chance else (low, mid)
    return high


def _factor(share: float) -> float:
    """Makes the covariance of the nearest `share` of normal vectors that of all of them."""
    return share / _below(quantile(share), _P + 2)


def _count(batch: pa.RecordBatch) -> dict:
    texts = octets_of(batch)
    parts = [counts_of(texts[a:b]) for a, b in octets.batches(texts)]
    return {"row": batch.column("row"), **{k: np.concatenate([p[k] for p in parts]) if parts else [] for k in NAMES}}


def statistics(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns `keep` of `docs` in `row`, and the counts of `text_stats` (null text: none of anything)."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col("text").cast("binary").alias("text"))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, " + ", ".join(f"{c} long" for c in NAMES)
    return map_arrow(rows, _count, schema)


def _vector() -> dict[str, Column]:
    n = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "x0": F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n),
        "x1": F.log1p(F.col("n_symbols") / n),
        "x2": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "x3": F.col("n_repeat_words") / n,
    }


def _moments(rows: DataFrame) -> DataFrame:
    sums = [F.sum(x).alias(f"s_{x}") for x in _X] + [F.sum(F.col(_X[i]) * F.col(_X[j])).alias(f"q_{i}_{j}") for i, j in _PAIRS]
    return rows.groupBy("g").agg(F.count("*").alias("k"), *sums)


def _solve(batch: pa.RecordBatch, factor: float) -> dict:
    """Centre, inverse covariance and log determinant of each group from its moments."""
    out: dict[str, list] = {"centre": [], "inverse": [], "logdet": []}
    for m in batch.to_pylist():
        k = max(1, m["k"])
        centre = np.array([m[f"s_{x}"] for x in _X]) / k
        second = np.zeros((_P, _P))
        for i, j in _PAIRS:
            second[i, j] = second[j, i] = m[f"q_{i}_{j}"] / k
        cov = factor * (second - np.outer(centre, centre)) + _FLOOR
        out["centre"].append(centre.tolist())
        out["inverse"].append(np.linalg.inv(cov).ravel().tolist())
        out["logdet"].append(float(np.linalg.slogdet(cov)[1]))
    return {"g": batch.column("g"), **out}


_FIT = "g string, centre array<double>, inverse array<double>, logdet double"


def _fit(rows: DataFrame, factor: float = 1.0) -> DataFrame:
    return saved(map_arrow(_moments(rows), _solve, _FIT, factor), "fit")


def distance() -> Column:
    """Squared Mahalanobis distance of x0.. from `centre` by `inverse`."""
    off = [F.col(x) - F.col("centre")[i] for i, x in enumerate(_X)]
    return sum((off[i] * off[j] * F.col("inverse")[i * _P + j] * (1 if i == j else 2) for i, j in _PAIRS), F.lit(0.0))


def _near(rows: DataFrame, fit: DataFrame) -> DataFrame:
    return rows.join(small(fit, 400), "g").withColumn("d2", distance())


def _concentrate(rows: DataFrame, fit: DataFrame, steps: int) -> DataFrame:
    for _ in range(steps):
        at = _near(rows, fit)
        reach = saved(at.groupBy("g").agg(F.percentile_approx("d2", SUPPORT, 10_000).alias("reach")), "reach")
        fit = _fit(at.join(small(reach, 100), "g").where("d2 <= reach").select("g", *_X))
    return fit


def estimate(rows: DataFrame, steps: int = STEPS) -> DataFrame:
    """g, centre, inverse, logdet of each group g of `rows` (g, x0..): minimum covariance determinant, reweighted."""
    middle = rows.groupBy("g").agg(*[F.percentile_approx(x, 0.5, 1000).alias(f"m_{x}") for x in _X])
    spread = rows.join(small(saved(middle, "middle"), 100), "g").groupBy("g").agg(
        F.array(*[F.first(f"m_{x}") for x in _X]).alias("centre"), *[F.percentile_approx(F.abs(F.col(x) - F.col(f"m_{x}")), 0.5, 1000).alias(f"d_{x}") for x in _X])
    variance = [F.pow(1.4826 * F.col(f"d_{x}"), 2) + float(_FLOOR[i, i]) for i, x in enumerate(_X)]
    inverse = F.array(*[F.lit(0.0) if i != j else 1 / variance[i] for i in range(_P) for j in range(_P)])
    robust = saved(spread.select("g", "centre", inverse.alias("inverse"), F.lit(0.0).alias("logdet")), "fit")
    # both starts take their steps together: a group's rows count once under the name of each
    named = {name: F.concat(F.lit(name), F.col("g")) for name in "rm"}
    both = rows.withColumn("g", F.explode(F.array(*named.values())))
    starts = robust.withColumn("g", named["r"]).unionByName(_fit(rows).withColumn("g", named["m"]))
    found = _concentrate(both, starts, steps).withColumn("g", F.expr("substring(g, 2)"))
    best = found.groupBy("g").agg(F.min_by(F.struct("centre", "inverse", "logdet"), "logdet").alias("f")).select("g", "f.*")
    # the nearest share is made to stand for all before the last step takes in what is then within reach
    scaled = best.withColumn("inverse", F.transform("inverse", lambda v: v / _factor(SUPPORT)))
    wide = _near(rows, saved(scaled, "fit")).where(F.col("d2") <= quantile(0.975))
    return _fit(wide.select("g", *_X), _factor(0.975))


def judge(docs: DataFrame, keep: list[str], reject: float = REJECT) -> DataFrame:
    """`row` (the columns `keep`), the counts, base_failed, d2 and kept of every row of `docs`.

    `docs` has text, lang and source. Null text has no words and fails the base rules; null language or source is a
    value of its own. Repeated rows are judged alike. A table in which nothing passes the base rules rejects all.
    """
    keep = list(dict.fromkeys([*keep, "lang", "source"]))
    stats = statistics(docs, keep).withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    named = lambda c: F.coalesce(F.concat(F.lit("="), F.col(f"row.{c}").cast("string")), F.lit("-"))
    tags = {"g_all": F.lit("all"), "g_lang": F.concat(F.lit("l"), named("lang")), "g_own": F.concat(F.lit("s"), named("lang"), F.lit("\x1f"), named("source"))}
    stats = saved(stats.withColumns(_vector()).withColumns(tags), "statistics")
    sound = stats.where("not base_failed")
    tagged = sound.select(F.explode(F.array(*tags)).alias("g"), *_X)
    sizes = saved(tagged.groupBy("g").agg(F.count("*").alias("k")), "sizes")
    large = sizes.where((F.col("k") >= LEAST_ROWS) | (F.col("g") == "all")).select("g")
    rows = saved(tagged.join(small(large, 100), "g"), "vectors")
    fits = estimate(rows)
    fit = lambda tag, to: small(fits, 400).select(F.col("g").alias(tag), F.struct("centre", "inverse").alias(to))
    out = stats.join(fit("g_own", "f1"), "g_own", "left").join(fit("g_lang", "f2"), "g_lang", "left").join(fit("g_all", "f3"), "g_all", "left")
    out = out.withColumn("f", F.coalesce("f1", "f2", "f3")).withColumns({"centre": F.col("f.centre"), "inverse": F.col("f.inverse")}).withColumn("d2", distance())
    kept = ~F.col("base_failed") & (F.coalesce("d2", F.lit(0.0)) <= cut(reject))
    return out.select("row", *NAMES, "base_failed", "d2", kept.alias("kept"))


COUNTS = ("word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def quality_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, the four counts, base_failed, kept, and the squared distance d2."""
    out = judge(docs, ["doc_id"])
    return out.select(F.col("row.doc_id").alias("doc_id"), "n_words", *COUNTS, "base_failed", "kept", "d2")


def keep_quality(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that pass, columns as they were."""
    return judge(docs, docs.columns).where("kept").select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
