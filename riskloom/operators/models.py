"""Distributed model fits: boosted trees (see ``trees``) and a Laplace-approximate
Bayesian logistic regression.

Posterior: priors intercept ~ N(0, 2^2), slopes ~ N(0, 1) on the standardised design
matrix, Bernoulli likelihood. The MAP comes from damped Newton steps started at the
prevalence logit. The log posterior is strictly concave, since the prior adds its
precision to the Hessian. Each step is one pass over all rows that leaves a packed row of sums per
task, added up before they reach the driver, which only solves a d x d system; a fit that does not settle is an
error. The posterior covariance is the inverse Hessian at the MAP. Under this normal law scoring needs no draws: ``mu`` and
``sd`` per row, the posterior mean of the sigmoid by 20-point Gauss-Hermite quadrature and the equal-tail
interval as ``sigmoid(mu +- z sd)`` (the sigmoid is monotone). Where the posterior is skewed (few rows, rare labels) it can be
sampled instead: proposals around the mode, weighed by their exact posterior, all of them in one pass over the rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.stats import balanced_sum, sigmoid
from riskloom.operators.encode import DesignModel, fit_design
from riskloom.operators.trees import TreeModel, fit_trees, summed

# Prior scales of intercept and slopes, quadrature order, Newton settings.
PRIOR_SD_INTERCEPT = 2.0
PRIOR_SD_SLOPE = 1.0
GAUSS_HERMITE_POINTS = 20
NEWTON_MAX_STEPS = 25
NEWTON_TOL = 1e-10
# Widest design that is fitted.
MAX_COLUMNS = 2_000
# Sampling: proposals for each draw, degrees of freedom and widening of the proposal, rounds that fit it anew, least share of
# effective draws; rows scored against all draws at once.
PROPOSALS, PROPOSAL_DF, WIDEN, ROUNDS, LEAST_EFFECTIVE = 4, 6, 1.2, 4, 0.5
SCORED_AT_ONCE = 2_048


def q(name: str) -> Column:
    return F.col(f"`{name}`")


# -- boosted trees ---------------------------------------------------------------------
def fit_gbt(
    train: DataFrame,
    continuous: list[str],
    categorical: list[str],
    label: str,
    params: dict | None = None,
    *,
    balance: bool = False,
) -> TreeModel:
    """Boosted trees of ``trees.fit_trees``; ``is_unbalance`` among the parameters weights the classes."""
    params = dict(params or {})
    balance = bool(params.pop("is_unbalance", False)) or balance
    return fit_trees(train, continuous, categorical, label, params, balance=balance)


def gbt_score(model: TreeModel, df: DataFrame, out: str = "p_raw") -> DataFrame:
    """``df`` with the positive-class probability."""
    return model.score(df, out)


# -- Laplace posterior --------------------------------------------------------------------
@dataclass
class PosteriorModel:
    design: DesignModel
    mean: list[float] = field(default_factory=list)  # intercept first
    cov: list[list[float]] = field(default_factory=list)
    ci_level: float = 0.90
    n_train: int = 0
    draws: list[list[float]] | None = None  # of the coefficients, if the posterior was sampled

    def _score_draws(self, df: DataFrame, keep: list[str], level: float) -> DataFrame:
        """Mean and equal-tail quantiles of the sigmoid over the draws, one matrix product per slice of an Arrow batch."""
        beta = np.array(self.draws)
        ends = [(1 - level) / 2, 1 - (1 - level) / 2]

        @F.pandas_udf("probability double, ci_low double, ci_high double, mu double, sd double")
        def summary(x: pd.Series) -> pd.DataFrame:
            out = [np.zeros((0, 5))]
            for a in range(0, len(x), SCORED_AT_ONCE):
                eta = np.stack(x.iloc[a : a + SCORED_AT_ONCE].to_numpy()) @ beta.T
                p = 1.0 / (1.0 + np.exp(-eta))
                out.append(np.column_stack([p.mean(1), *np.quantile(p, ends, axis=1), eta.mean(1), eta.std(1)]))
            return pd.DataFrame(np.concatenate(out), columns=["probability", "ci_low", "ci_high", "mu", "sd"])

        rows = df.select(*[q(k) for k in keep], summary(self.design.packed()).alias("_rl_s"))
        return rows.select(*[q(k) for k in keep], "_rl_s.*")

    def score(self, df: DataFrame, keep: list[str], level: float | None = None) -> DataFrame:
        """``keep + (probability, ci_low, ci_high, mu, sd)``: posterior mean and interval.

        ``mu = x'm`` and ``sd = |L'x|`` with ``L`` the Cholesky factor of the covariance, one matrix product
        per Arrow batch; the rest are Column expressions.
        """
        level = level or self.ci_level
        if self.draws:
            return self._score_draws(df, keep, level)
        mean_, factor = np.array(self.mean), np.linalg.cholesky(np.array(self.cov))

        @F.pandas_udf("mu double, sd double")
        def linear(x: pd.Series) -> pd.DataFrame:
            m = np.stack(x.to_numpy()) if len(x) else np.zeros((0, len(mean_)))
            return pd.DataFrame({"mu": m @ mean_, "sd": np.linalg.norm(m @ factor, axis=1)})

        packed = df.select(*[q(k) for k in keep], self.design.packed().alias("_rl_x"))
        staged = packed.select(*[q(k) for k in keep], linear("_rl_x").alias("_rl_l")).select(*[q(k) for k in keep], "_rl_l.mu", "_rl_l.sd")
        z = NormalDist().inv_cdf(1.0 - (1.0 - level) / 2.0)
        nodes, weights = np.polynomial.hermite.hermgauss(GAUSS_HERMITE_POINTS)
        mean = balanced_sum(
            [F.lit(float(w / math.sqrt(math.pi))) * sigmoid(F.col("mu") + F.lit(float(math.sqrt(2.0) * t)) * F.col("sd"))
             for t, w in zip(nodes, weights)]
        )
        return staged.select(
            *[q(k) for k in keep],
            mean.alias("probability"),
            sigmoid(F.col("mu") - F.lit(z) * F.col("sd")).alias("ci_low"),
            sigmoid(F.col("mu") + F.lit(z) * F.col("sd")).alias("ci_high"),
            "mu",
            "sd",
        )

    def to_dict(self) -> dict:
        return {"design": self.design.to_dict(), "mean": self.mean, "cov": self.cov, "ci_level": self.ci_level,
                "n_train": self.n_train, "draws": self.draws}

    @classmethod
    def from_dict(cls, d: dict) -> PosteriorModel:
        return cls(DesignModel.from_dict(d["design"]), d["mean"], d["cov"], d["ci_level"], d.get("n_train", 0), d.get("draws"))


def _partition_sums(packed: DataFrame, d: int, beta: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Gradient, Hessian and log-likelihood at ``beta``.

    One BLAS product per Arrow batch, one packed row of ``d^2 + d + 1`` numbers per task, added up in a tree.
    """
    b = np.asarray(beta, dtype=float)
    size = d * d + d + 1

    def part(batches):
        total = np.zeros(size)
        for pdf in batches:
            if len(pdf) == 0:
                continue
            x = np.stack(pdf["x"].to_numpy())
            y = pdf["y"].to_numpy(dtype=float)
            eta = x @ b
            mu = 1.0 / (1.0 + np.exp(-eta))
            h = x.T @ (x * (mu * (1.0 - mu))[:, None])
            total += np.concatenate([h.ravel(), x.T @ (mu - y), [np.sum(y * eta - np.logaddexp(0.0, eta))]])
        yield pd.DataFrame({"v": [total.tobytes()]})

    v = summed(packed.mapInPandas(part, "v binary"), size, packed.rdd.getNumPartitions())
    return v[d * d : d * d + d], v[: d * d].reshape(d, d), float(v[-1])


def _log_likelihoods(packed: DataFrame, beta: np.ndarray) -> np.ndarray:
    """Log-likelihood of each row of ``beta``: one pass, one sum per row and task."""

    def part(batches):
        total = np.zeros(len(beta))
        for pdf in batches:
            for a in range(0, len(pdf), SCORED_AT_ONCE):
                x = np.stack(pdf["x"].iloc[a : a + SCORED_AT_ONCE].to_numpy())
                y = pdf["y"].iloc[a : a + SCORED_AT_ONCE].to_numpy(dtype=float)
                eta = x @ beta.T
                total += y @ eta - np.logaddexp(0.0, eta).sum(0)
        yield pd.DataFrame({"v": [total.tobytes()]})

    return summed(packed.mapInPandas(part, "v binary"), len(beta), packed.rdd.getNumPartitions())


def _sample(packed: DataFrame, mean: np.ndarray, cov: np.ndarray, prior_prec: np.ndarray, draws: int, seed: int = 1) -> np.ndarray:
    """Draws of the posterior by adaptive importance resampling.

    Proposals come from a heavy-tailed law around the mode; one pass over the rows gives the exact log posterior of all
    of them. Their weights show how good the proposal was: while too few count, it is fitted anew to the
    weighted proposals. The last ones are resampled by weight. An error if the proposal never gets close enough (very many columns).
    """
    rng = np.random.default_rng(seed)
    d, k = len(mean), PROPOSALS * draws
    best = None
    for _ in range(ROUNDS):
        factor = np.linalg.cholesky(cov * WIDEN**2)
        normal = rng.standard_normal((k, d))
        scale = np.sqrt(PROPOSAL_DF / rng.chisquare(PROPOSAL_DF, k))
        beta = mean + (normal * scale[:, None]) @ factor.T
        distance = (normal**2).sum(1) * scale**2
        proposal = -0.5 * (PROPOSAL_DF + d) * np.log1p(distance / PROPOSAL_DF)
        log_w = _log_likelihoods(packed, beta) - 0.5 * (prior_prec * beta**2).sum(1) - proposal
        w = np.exp(log_w - log_w.max())
        w /= w.sum()
        effective = 1 / (w**2).sum() / draws
        if best is None or effective > best[0]:
            best = effective, beta, w
        if effective >= LEAST_EFFECTIVE * PROPOSALS:
            break
        mean = w @ beta
        cov = (beta - mean).T @ ((beta - mean) * w[:, None]) + 1e-9 * np.eye(d)
    effective, beta, w = best
    if effective < LEAST_EFFECTIVE:
        raise NotConverged(f"only {effective * draws:.0f} effective draws of {draws}; use the normal law (draws=0)")
    at = np.searchsorted(np.cumsum(w), (rng.random() + np.arange(draws)) / draws)  # systematic resampling
    return beta[np.minimum(at, k - 1)]


class NotConverged(RuntimeError):
    """The Newton steps of the posterior fit did not settle."""


def fit_posterior(
    df: DataFrame,
    numeric: list[str],
    categorical: list[str],
    label: str,
    *,
    ci_level: float = 0.90,
    partitions: int | None = None,
    draws: int = 0,
) -> PosteriorModel:
    """Laplace posterior of the Bayesian logistic regression on all rows of ``df``.

    ``partitions`` deals the rows out before the steps; by default they stay as they are. With ``draws`` the posterior
    itself is sampled (see ``_sample``) and scores come from the draws; without, from the normal law at the mode.
    """
    design_model = fit_design(df, numeric, categorical)
    d = len(design_model.output_columns) + 1
    if d > MAX_COLUMNS:
        raise ValueError(f"{d} design columns; the driver solves a dense system of at most {MAX_COLUMNS}")
    labelled = df.where(q(label).isNotNull())
    if partitions:
        labelled = labelled.repartition(partitions)
    packed = labelled.select(design_model.packed().alias("x"), q(label).cast("double").alias("y")).persist()
    n = packed.count()
    prior_prec = np.array([1.0 / PRIOR_SD_INTERCEPT**2] + [1.0 / PRIOR_SD_SLOPE**2] * (d - 1))
    # Start at the prevalence logit; the log posterior is strictly concave (the prior
    # adds its precision to the Hessian), so damped Newton converges in a few aggregates.
    pos = float(packed.agg(F.sum("y")).first()[0] or 0.0)
    rate = min(max(pos / n, 1e-6), 1 - 1e-6) if n else 0.5
    beta = np.zeros(d)
    beta[0] = math.log(rate / (1.0 - rate))

    def log_post(g_ll: float, b: np.ndarray) -> float:
        return g_ll - 0.5 * float(np.sum(prior_prec * b * b))

    g, h, ll = _partition_sums(packed, d, beta)
    current = log_post(ll, beta)
    for _ in range(NEWTON_MAX_STEPS):
        grad = g + prior_prec * beta
        step = np.linalg.solve(h + np.diag(prior_prec), grad)
        if 0.5 * float(grad @ step) < NEWTON_TOL:  # Newton decrement: converged
            break
        t = 1.0
        while True:
            cand = beta - t * step
            g_c, h_c, ll_c = _partition_sums(packed, d, cand)
            value = log_post(ll_c, cand)
            if value >= current - 1e-9 * max(1.0, abs(current)):
                break
            t /= 2.0
            if t < 1e-6:
                packed.unpersist()
                raise NotConverged("no step along the Newton direction improves the fit")
        beta, g, h, current = cand, g_c, h_c, value
    else:
        packed.unpersist()
        raise NotConverged(f"no convergence in {NEWTON_MAX_STEPS} steps")
    h_post = h + np.diag(prior_prec)
    cov = np.linalg.inv(h_post)
    cov = (cov + cov.T) / 2.0
    sampled = _sample(packed, beta, cov, prior_prec, draws).tolist() if draws else None
    packed.unpersist()
    return PosteriorModel(design_model, [float(b) for b in beta], cov.tolist(), ci_level, n, sampled)
