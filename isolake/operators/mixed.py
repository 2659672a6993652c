"""Association by a linear mixed model: y = X b + f g + u + e with u ~ N(0, s2 h K), one feature f at a time."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isolake.errors import ContractError, LimitError


def rotated(kinship: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, eigenvectors) of a kinship matrix; eigenvalues below zero by rounding are zero."""
    values, vectors = np.linalg.eigh((kinship + kinship.T) / 2)
    return np.maximum(values, 0.0), vectors


def gls(x: np.ndarray, y: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """(coefficients, inverse of X' D^-1 X, residual sum of squares) of least squares with variances d."""
    w = x / d[:, None]
    inverse = np.linalg.pinv(x.T @ w)
    beta = inverse @ (w.T @ y)
    r = y - x @ beta
    return beta, inverse, float((r * r / d).sum())


def restricted_likelihood(h: float, x: np.ndarray, y: np.ndarray, values: np.ndarray) -> float:
    """REML log likelihood of rotated data at heritability h, but for a constant."""
    d = h * values + (1 - h)
    _, inverse, rss = gls(x, y, d)
    df = len(y) - x.shape[1]
    return -0.5 * (df * math.log(max(rss, 1e-300) / df) + np.log(d).sum() - np.linalg.slogdet(inverse)[1])


def heritability(x: np.ndarray, y: np.ndarray, values: np.ndarray) -> float:
    """The h of greatest restricted likelihood: the best of a grid, refined by golden sections around it."""
    return _best(lambda h: restricted_likelihood(h, x, y, values))


def _best(likelihood: Callable[[float], float]) -> float:
    grid = np.linspace(0.0, 0.999, 41)
    score = [likelihood(h) for h in grid]
    i = int(np.argmax(score))
    lo, hi = grid[max(0, i - 1)], grid[min(len(grid) - 1, i + 1)]
    ratio = (math.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = hi - ratio * (hi - lo), lo + ratio * (hi - lo)
        if likelihood(a) >= likelihood(b):
            hi = b
        else:
            lo = a
    return float((lo + hi) / 2)


def factored_model(features: DataFrame, outcome: DataFrame, factors: DataFrame | None = None, covariates: Sequence[str] = (), max_factors: int = 5_000) -> DataFrame:
    """The mixed model of kinship W W', with `factors` (feature, sample_id, value) as W; without factors all samples are unrelated. Columns as `mixed_model`.

    The kinship is never formed: its eigenvectors that count are W E S^-1/2 where W'W = E S E', so all that is needed of a variable is its sums over the
    samples, alone and by factor, and any number of samples will do. W'W is decomposed on the driver; more than `max_factors` factors are refused.
    A sample with several outcomes counts with the least of them; a null covariate is refused.
    """
    names = [f"x{i}" for i in range(len(covariates))]
    o = outcome.where("y IS NOT NULL AND sample_id IS NOT NULL").groupBy("sample_id").agg(F.min(F.struct(F.col("y").cast("double").alias("y"), *[F.col(c).cast("double").alias(x) for c, x in zip(covariates, names)])).alias("o")).select("sample_id", "o.*")
    mean = o.agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(c) for c in ("y", *names)], *[F.count(c).alias(f"n_{c}") for c in names]).first()
    n = int(mean.n)
    if any(mean[f"n_{c}"] < n for c in names):
        raise ContractError("a covariate is null")
    o = o.select("sample_id", F.lit(1.0).alias("one"), *[(F.col(c) - F.lit(mean[c])).alias(c) for c in (*names, "y")], F.col("y").alias("raw"))  # about the means, for precision
    columns = ["one", *names, "y"]
    *products, total = o.agg(*[F.coalesce(F.sum(F.col(a) * F.col(b)), F.lit(0.0)) for a in columns for b in columns], F.coalesce(F.sum("raw"), F.lit(0.0))).first()
    inner = np.array(products, float).reshape(len(columns), -1)
    basis, values = np.zeros((0, 0)), np.zeros(0)
    turned = np.zeros((0, len(columns)))
    of: dict[str, int] = {}
    if factors is not None:
        w = factors.where("feature IS NOT NULL AND value <> 0").groupBy(F.col("feature").alias("factor"), "sample_id").agg(F.sum(F.col("value").cast("double")).alias("value")).join(o.select("sample_id"), "sample_id", "left_semi")
        found = [r[0] for r in w.select("factor").distinct().limit(max_factors + 1).collect()]
        if len(found) > max_factors:
            raise LimitError(f"a mixed model is limited to {max_factors} factors of kinship")
        of = {f: i for i, f in enumerate(sorted(found))}
        gram, sums = np.zeros((len(of), len(of))), np.zeros((len(of), len(columns)))
        for r in w.join(w.select("sample_id", F.col("factor").alias("other"), F.col("value").alias("v")), "sample_id").groupBy("factor", "other").agg(F.sum(F.col("value") * F.col("v")).alias("s")).toLocalIterator():  # at most max_factors^2 rows
            gram[of[r.factor], of[r.other]] = r.s
        for r in w.join(o, "sample_id").groupBy("factor").agg(*[F.sum(F.col("value") * F.col(c)).alias(c) for c in columns]).collect():
            sums[of[r.factor]] = r[1:]
        s, e = rotated(gram) if of else (values, basis)
        kept = s > 1e-10 * s.max(initial=0.0)
        basis = e[:, kept] / np.sqrt(s[kept])  # a variable's sums by factor, times this, are its coordinates along the eigenvectors
        values = s[kept] * n / max(float(np.trace(gram)), 1e-12)
        turned = basis.T @ sums
    p, rest = len(columns) - 1, n - len(values)

    def weighed(h: float) -> tuple[np.ndarray, np.ndarray, float]:
        """(X' V^-1 X inverted, its product with X' V^-1 y, residual sum of squares)."""
        m = inner / (1 - h) + turned.T @ ((1 / (h * values + 1 - h) - 1 / (1 - h))[:, None] * turned)
        inverse = np.linalg.pinv(m[:p, :p])
        beta = inverse @ m[:p, p]
        return inverse, beta, max(float(m[p, p] - beta @ m[:p, p]), 0.0)

    def likelihood(h: float) -> float:
        inverse, _, rss = weighed(h)
        return -0.5 * ((n - p) * math.log(max(rss, 1e-300) / (n - p)) + np.log(h * values + 1 - h).sum() + rest * math.log(1 - h) - np.linalg.slogdet(inverse)[1])

    h = _best(likelihood) if factors is not None and n > p + 1 else 0.0
    inverse, beta0, rss0 = weighed(h) if n else (np.zeros((p, p)), np.zeros(p), 0.0)
    plain = np.linalg.pinv(inner[:p, :p])
    weight = 1 / (h * values + 1 - h) - 1 / (1 - h)
    shared = features.sparkSession.sparkContext.broadcast((basis, turned, weight))
    schema = "feature string, carriers long, beta double, se double, z double, p_value double"

    def fit(batches):
        basis, turned, weight = shared.value
        rows = max(1, 4_000_000 // max(1, len(basis)))
        for whole in batches:
            for at in range(0, len(whole), rows):
                pdf = whole.iloc[at : at + rows]
                k = pdf["carriers"].to_numpy(float)
                own = pdf[columns].to_numpy(float)  # sums over the carriers
                by = np.zeros((len(pdf), len(basis)))
                if len(basis):
                    for row, (factor, value) in enumerate(zip(pdf["factors"], pdf["sums"])):
                        if factor is not None:
                            by[row, factor] = value
                u = by @ basis
                cross = own / (1 - h) + (u * weight) @ turned
                vx, vy = cross[:, :p], cross[:, p]
                den = k / (1 - h) + (u * u) @ weight - ((vx @ inverse) * vx).sum(1)
                spanned = k - ((own[:, :p] @ plain) * own[:, :p]).sum(1) <= 1e-9 * np.maximum(k, 1)
                out = []
                for name, c, raw, none, top, low in zip(pdf["feature"], pdf["carriers"], pdf["raw"], spanned, vy - vx @ beta0, den):
                    if none or low <= 0:
                        out.append((name, c, None, None, None, 1.0))
                        continue
                    beta, rss = float(top / low), float(rss0 - top * top / low)
                    if p == 1 and not len(basis):
                        beta = raw / c - (total - raw) / (n - c)  # the same, without a rounding error at a tie
                    if rss <= 1e-13 * rss0:  # fitted without a rest
                        out.append((name, c, beta, 0.0, None, 0.0 if rss0 > 0 else 1.0))
                        continue
                    se = math.sqrt(rss / max(1, n - p - 1) / low)
                    out.append((name, c, beta, se, beta / se, math.erfc(abs(beta / se) / math.sqrt(2))))
                yield pd.DataFrame(out, columns=[c.split()[0] for c in schema.split(", ")])

    f = features.select("feature", "sample_id").where("feature IS NOT NULL").distinct()
    per = f.join(o, "sample_id").groupBy("feature").agg(F.count(F.lit(1)).alias("carriers"), *[F.sum(c).alias(c) for c in (*columns, "raw")])
    if of:
        number = features.sparkSession.createDataFrame(list(of.items()), "factor string, i int")
        coded = w.join(F.broadcast(number), "factor")
        met = f.join(coded.select("sample_id", "i", "value"), "sample_id").groupBy("feature", "i").agg(F.sum("value").alias("s")).groupBy("feature").agg(F.collect_list(F.struct("i", "s")).alias("fs"))  # at most max_factors a feature
        per = per.join(met.select("feature", F.col("fs.i").alias("factors"), F.col("fs.s").alias("sums")), "feature", "left")
    return per.mapInPandas(fit, schema)


def mixed_model(features: DataFrame, outcome: DataFrame, kinship: DataFrame | None, covariates: Sequence[str] = (), max_samples: int = 5_000) -> DataFrame:
    """(feature, carriers, beta, se, z, p_value) of every feature given covariates and kinship.

    `features` (feature, sample_id) lists carriers, `outcome` (sample_id, y, covariates...) is one row a sample, `kinship` (a, b, value) its upper half;
    pairs that are not there are 0. The kinship of n samples is decomposed once, on the driver, as its n x n numbers are needed at once; more than
    `max_samples` are refused, and that bounds what is sent to the workers. Without kinship all samples are unrelated, and any number will do
    (`factored_model`, which also takes a kinship that is the product of a feature matrix). Features are spread over the
    cluster. p is that of the normal distribution. A feature without variation, or in the span of the covariates, has p 1.
    """
    if kinship is None:
        return factored_model(features, outcome, None, covariates)
    spark = features.sparkSession
    rows = outcome.where("y IS NOT NULL AND sample_id IS NOT NULL").select("sample_id", F.col("y").cast("double").alias("y"), *[F.col(c).cast("double").alias(c) for c in covariates]).dropDuplicates(["sample_id"]).limit(max_samples + 1).toPandas()
    if len(rows) > max_samples:
        raise LimitError(f"a mixed model is limited to {max_samples} samples")
    rows = rows.sort_values("sample_id").reset_index(drop=True)
    at = {s: i for i, s in enumerate(rows["sample_id"])}
    n = len(rows)
    k = np.zeros((n, n))
    inside = kinship.join(outcome.select(F.col("sample_id").alias("a")), "a", "left_semi").join(outcome.select(F.col("sample_id").alias("b")), "b", "left_semi")
    for r in inside.select("a", "b", "value").toLocalIterator():  # at most max_samples^2 / 2 rows
        if r.a in at and r.b in at:
            k[at[r.a], at[r.b]] = k[at[r.b], at[r.a]] = r.value
    k *= n / max(np.trace(k), 1e-12)
    x = np.column_stack([np.ones(n), *[rows[c] for c in covariates]]) if n else np.ones((0, 1))
    y = rows["y"].to_numpy(float)
    values, vectors = rotated(k) if n else (np.zeros(0), np.zeros((0, 0)))
    xr, yr = vectors.T @ x, vectors.T @ y
    h = heritability(xr, yr, values) if n > x.shape[1] + 1 else 0.0
    shared = spark.sparkContext.broadcast((at, vectors, xr, yr, h * values + (1 - h), x))
    schema = "feature string, carriers long, beta double, se double, z double, p_value double"

    def fit(batches):
        at, vectors, xr, yr, d, x = shared.value
        for pdf in batches:
            out = []
            for name, ids in zip(pdf["feature"], pdf["ids"]):
                v = np.zeros(len(yr))
                v[[at[s] for s in ids if s in at]] = 1
                carriers = int(v.sum())
                fitted, *_ = np.linalg.lstsq(x, v, rcond=None)
                if not len(yr) or np.abs(x @ fitted - v).max() <= 1e-9:
                    out.append((name, carriers, None, None, None, 1.0))
                    continue
                design = np.column_stack([xr, vectors.T @ v])
                beta, inverse, rss = gls(design, yr, d)
                se = math.sqrt(rss / max(1, len(yr) - design.shape[1]) * inverse[-1, -1])
                z = float(beta[-1] / se) if se > 0 else None
                out.append((name, carriers, float(beta[-1]), se, z, math.erfc(abs(z) / math.sqrt(2)) if z is not None else 1.0))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in schema.split(", ")])

    carriers = features.select("feature", "sample_id").where("feature IS NOT NULL").join(outcome.where("y IS NOT NULL").select("sample_id").distinct(), "sample_id", "left_semi")
    per = carriers.groupBy("feature").agg(F.collect_set("sample_id").alias("ids"))  # at most max_samples ids a feature
    return per.mapInPandas(fit, schema)
