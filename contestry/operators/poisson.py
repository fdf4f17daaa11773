"""Dixon-Coles score probabilities, fitted and scored as DataFrame operations.

All functions take the grouping keys of a fit (a competition, or a fold and a competition), so any
number of fits runs as one job. Rows of one fit (means, rho) are broadcast, those of teams never.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contestry.sources.store import large

MAX_GOALS = 10
#: The grid of the low-score correction.
RHO_GRID = [round(-0.15 + 0.025 * i, 4) for i in range(13)]
FLOOR = 1e-12


def ratings(train: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(league means by keys; attack and defence by keys and team): mean ratios to the league's means."""
    means = train.groupBy(*keys).agg(F.avg("home_goals").alias("mean_home"), F.avg("away_goals").alias("mean_away"))
    sides = train.join(F.broadcast(means), keys).select(*keys, F.explode(F.array(
        F.struct(F.col("home_team_id").alias("team_id"), (F.col("home_goals") / F.greatest("mean_home", F.lit(1e-6))).alias("scored"), (F.col("away_goals") / F.greatest("mean_away", F.lit(1e-6))).alias("conceded")),
        F.struct(F.col("away_team_id").alias("team_id"), (F.col("away_goals") / F.greatest("mean_away", F.lit(1e-6))).alias("scored"), (F.col("home_goals") / F.greatest("mean_home", F.lit(1e-6))).alias("conceded")),
    )).alias("s")).select(*keys, "s.*")
    return means, sides.groupBy(*keys, "team_id").agg(F.avg("scored").alias("attack"), F.avg("conceded").alias("defence"))


def with_rates(matches: DataFrame, means: DataFrame, teams: DataFrame, keys: list[str]) -> DataFrame:
    """matches with lam and mu, the expected goals; unseen teams rate 1."""
    out = matches.join(F.broadcast(means), keys)
    for side in ("home", "away"):
        rated = teams.select(*keys, F.col("team_id").alias(f"{side}_team_id"), F.col("attack").alias(f"{side}_attack"), F.col("defence").alias(f"{side}_defence"))
        out = out.join(large(rated), [*keys, f"{side}_team_id"], "left")
    one = lambda c: F.coalesce(c, F.lit(1.0))
    lam = F.col("mean_home") * one("home_attack") * one("away_defence")
    mu = F.col("mean_away") * one("away_attack") * one("home_defence")
    floor = F.lit(1e-6)
    return out.withColumns({"lam": F.greatest(lam, floor), "mu": F.greatest(mu, floor)}).drop("mean_home", "mean_away", "home_attack", "home_defence", "away_attack", "away_defence")


def pmf(rate: Column) -> Column:
    """Poisson probabilities of 0 to MAX_GOALS as an array."""
    return F.transform(F.sequence(F.lit(0), F.lit(MAX_GOALS)), lambda k: F.exp(-rate) * F.pow(rate, k) / F.factorial(k))


def total(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(0.0), lambda a, b: a + b)


def cell(home_goals: Column, away_goals: Column, lam: Column, mu: Column, rho: Column) -> Column:
    """The unnormalised probability of a score, with the correction of low scores."""
    plain = F.exp(-lam - mu) * F.pow(lam, home_goals) * F.pow(mu, away_goals) / F.factorial(home_goals) / F.factorial(away_goals)
    at = lambda h, a: (home_goals == h) & (away_goals == a)
    tau = F.when(at(0, 0), 1 - lam * mu * rho).when(at(0, 1), 1 + lam * rho).when(at(1, 0), 1 + mu * rho).when(at(1, 1), 1 - rho).otherwise(1.0)
    return plain * tau


def best_rho(rated: DataFrame, keys: list[str]) -> DataFrame:
    """Per keys the rho of least negative log-likelihood; the first of equals.

    The corrections cancel in the sum over all scores, so the normaliser needs no rho.
    """
    capped = lambda c: F.least(F.col(c), F.lit(MAX_GOALS)).cast("int")
    norm = total(pmf(F.col("lam"))) * total(pmf(F.col("mu")))
    tried = rated.withColumn("norm", norm).withColumn("rho", F.explode(F.array(*[F.lit(r) for r in RHO_GRID])))
    p = cell(capped("home_goals"), capped("away_goals"), F.col("lam"), F.col("mu"), F.col("rho")) / F.col("norm")
    nll = tried.groupBy(*keys, "rho").agg(F.round(-F.sum(F.ln(F.greatest(p, F.lit(FLOOR)))), 9).alias("nll"))
    return nll.groupBy(*keys).agg(F.min_by("rho", F.struct("nll", "rho")).alias("rho"))


def outcome_probabilities(rated: DataFrame) -> DataFrame:
    """rated (lam, mu, rho) with p_away, p_draw, p_home: sums below, on and above the diagonal."""
    out = rated.withColumns({"h_": pmf(F.col("lam")), "a_": pmf(F.col("mu"))})
    low = F.exp(-F.col("lam") - F.col("mu")) * F.col("lam") * F.col("mu") * F.col("rho")
    # the four corrected cells move this much: 0-0 and 1-1 lose it, 1-0 and 0-1 gain it
    same = total(F.zip_with("h_", "a_", lambda x, y: x * y)) - 2 * low
    cumulated = lambda c: F.transform(F.sequence(F.lit(0), F.lit(MAX_GOALS)), lambda k: total(F.slice(c, 1, k)))
    home = total(F.zip_with("h_", cumulated("a_"), lambda x, y: x * y)) + low
    away = total(F.zip_with("a_", cumulated("h_"), lambda x, y: x * y)) + low
    out = out.withColumns({"p_home": home, "p_draw": same, "p_away": away})
    every = F.col("p_home") + F.col("p_draw") + F.col("p_away")
    return out.withColumns({p: F.col(p) / every for p in ("p_away", "p_draw", "p_home")}).drop("h_", "a_")


def fit_and_predict(train: DataFrame, matches: DataFrame, keys: list[str]) -> DataFrame:
    """matches with p_away, p_draw and p_home from a fit on train, for each value of keys."""
    means, teams = ratings(train, keys)
    rho = best_rho(with_rates(train, means, teams, keys), keys)
    return outcome_probabilities(with_rates(matches, means, teams, keys).join(F.broadcast(rho), keys)).drop("lam", "mu", "rho")
