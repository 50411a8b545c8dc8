"""Quality classifier: sparse rule ensemble compiled into Spark columns."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold, table

FEATURES = ("n_chars", "n_words", "word_len", "upper", "symbol", "digit", "exclaim", "line_len", "dup_lines", "distinct_words")


def statistics(docs: DataFrame) -> DataFrame:
    """Statistics of the whole text (null: empty); no identifier, language or source goes in. ``docs`` needs doc_id and text; of other
    columns those whose names begin with ``f_`` or are ``_w`` or ``_l`` would be hidden, so ``scored`` sets all of them aside first."""
    text = F.coalesce("text", F.lit(""))
    d = docs.withColumn("_w", F.split(F.trim(text), r"\s+")).withColumn("_l", F.filter(F.split(text, "\n"), lambda x: x != ""))
    n = F.greatest(F.char_length(text), F.lit(1))
    n_words = F.greatest(F.size("_w"), F.lit(1))
    n_lines = F.greatest(F.size("_l"), F.lit(1))
    values = {
        "n_chars": F.char_length(text), "n_words": n_words, "word_len": n / n_words,
        "upper": (n - F.char_length(F.regexp_replace(text, r"\p{Lu}", ""))) / n,
        "symbol": (n - F.char_length(F.translate(text, "#$%&*@^~|<>{}[]=_+\\", ""))) / n,
        "digit": (n - F.char_length(F.translate(text, "0123456789", ""))) / n,
        "exclaim": (n - F.char_length(F.translate(text, "!?", ""))) / n,
        "line_len": n / n_lines, "dup_lines": 1 - F.size(F.array_distinct("_l")) / n_lines,
        "distinct_words": F.size(F.array_distinct("_w")) / n_words,
    }
    out = d.select(*docs.columns, *[values[f].cast("double").alias(f"f_{f}") for f in FEATURES])
    # Through a generator of one row: a filter on the score would else be pushed below, with the statistics written out in each of hundreds of rules.
    return out.select(*docs.columns, F.inline(F.array(F.struct(*[f"f_{f}" for f in FEATURES]))))


def _gini_split(x: np.ndarray, y: np.ndarray, cols: np.ndarray, least: int) -> tuple | None:
    best, n = None, len(y)
    for c in cols:
        order = np.argsort(x[:, c], kind="stable")
        v, t = x[order, c], y[order]
        up = np.cumsum(t)
        k = np.arange(1, n)
        ok = (v[1:] > v[:-1]) & (k >= least) & (n - k >= least)
        if not ok.any():
            continue
        p, q = up[:-1] / k, (up[-1] - up[:-1]) / (n - k)
        cost = np.where(ok, k * p * (1 - p) + (n - k) * q * (1 - q), np.inf)
        i = int(np.argmin(cost))
        if best is None or cost[i] < best[0]:
            best = (cost[i], int(c), float((v[i] + v[i + 1]) / 2))
    return best


def _paths(x, y, rng, depth, least, path=()) -> list[tuple]:
    if depth == 0 or len(y) < 2 * least or y.min() == y.max():
        return []
    best = _gini_split(x, y, rng.choice(x.shape[1], max(2, x.shape[1] // 2), replace=False), least)
    if best is None:
        return []
    _, c, at = best
    low = x[:, c] <= at
    out = [(*path, (c, True, at)), (*path, (c, False, at))]
    return out + _paths(x[low], y[low], rng, depth - 1, least, out[0]) + _paths(x[~low], y[~low], rng, depth - 1, least, out[1])


def _holds(rule: tuple, x: np.ndarray) -> np.ndarray:
    return np.logical_and.reduce([(x[:, c] <= at) if low else (x[:, c] > at) for c, low, at in rule])


def fit_rules(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, penalty: float = 0.002, steps: int = 1500, seed: int = 5) -> tuple[list, np.ndarray, float]:
    """Tree paths on bootstrap samples as rules, then lasso logistic weights by proximal gradient. Rules of weight 0 go."""
    if len(y) == 0 or y.min() == y.max():
        return [], np.zeros(0), 4.0 if len(y) and y[0] == 1 else -4.0 if len(y) else 0.0
    rng, rules = np.random.default_rng(seed), {}
    for _ in range(trees):
        at = rng.integers(0, len(y), len(y))
        rules |= dict.fromkeys(_paths(x[at], y[at], rng, depth, max(2, len(y) // 200)))
    rules = list(rules)
    if not rules:
        return [], np.zeros(0), float(np.log(y.mean() / (1 - y.mean())))
    z = np.empty((len(y), len(rules)))
    for k, r in enumerate(rules):
        z[:, k] = _holds(r, x)
    w, b = np.zeros(z.shape[1]), float(np.log(y.mean() / (1 - y.mean())))
    ones = z.sum(axis=0)
    products = np.block([[z.T @ z, ones[:, None]], [ones, np.full(1, len(y))]])  # small, where a norm of z and a column of ones copies all of z
    rate = 4 * len(y) / np.linalg.eigvalsh(products)[-1]
    for _ in range(steps):
        g = 1 / (1 + np.exp(-(z @ w + b))) - y
        b -= rate * g.mean()
        w = w - rate * (z.T @ g) / len(y)
        w = np.sign(w) * np.maximum(np.abs(w) - rate * penalty, 0)
    keep = np.flatnonzero(w)
    return [rules[i] for i in keep], w[keep], b


def compile_rules(rules: list, weights: np.ndarray, bias: float) -> Column:
    """The ensemble as one column: sigmoid of the weights whose conjunction holds."""
    total = F.lit(float(bias))
    for rule, w in zip(rules, weights, strict=True):
        held = None
        for c, low, at in rule:
            test = F.col(f"f_{FEATURES[c]}") <= at if low else F.col(f"f_{FEATURES[c]}") > at
            held = test if held is None else held & test
        total = total + F.when(held, float(w)).otherwise(0.0)
    return 1 / (1 + F.exp(-total))


def train(docs: DataFrame, labels: DataFrame, bound: int = 20000) -> tuple[list, np.ndarray, float]:
    """Fit on at most ``bound`` labelled documents, those of least hashed id, of folds other than 1 (mod 3); repeated rows count once, and if ids
    that have many texts make more than ``bound`` rows, the first ones by hashed id and text are used."""
    some = labels.where("quality is not null and doc_id is not null").where(fold(F.col("doc_id"), 3) != 1).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    some = some.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    rows = statistics(docs.select("doc_id", "text").join(F.broadcast(some), "doc_id")).withColumn("text", F.xxhash64(F.coalesce("text", F.lit("")))).distinct()
    # As Arrow columns: rows as Python objects take many times as much of the driver's memory.
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(bound).toArrow().to_pandas().sort_values(["doc_id", "text"], kind="stable")
    return fit_rules(rows[[f"f_{f}" for f in FEATURES]].to_numpy(float), rows["quality"].to_numpy(float))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """All columns of documents plus quality_score, which replaces one of that name. Null text scores as empty; repeated rows score alike; with no labels every
    score is 0.5; with one label only, near that label."""
    kept = [c for c in docs.columns if c != "quality_score"]
    aside = docs.select("text", F.struct(*kept).alias("row"))
    return statistics(aside).withColumn("quality_score", compile_rules(*train(docs, labels))).select(*[F.col("row")[c].alias(c) for c in kept], "quality_score")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scored(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"), F.col("quality_score").alias("score"), (F.col("quality_score") >= 0.5).cast("int").alias("predicted"))
