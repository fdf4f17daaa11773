"""Evaluation of probability triples: metrics, calibration, blends and decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from contestry.functions.scalars import argmax_class
from contestry.operators.tables import CLASSES
from contestry.sources.store import large

TRIPLE = ["p_away", "p_draw", "p_home"]
EPSILON = 2.220446049250313e-16


def folds(matches: DataFrame, years: list[int]) -> DataFrame:
    """Each played contest once for every fold it has a role in: train before the fold's season, valid in it."""
    fold = matches.where("is_played").withColumn("fold", F.explode(F.array(*[F.lit(y) for y in years])))
    role = F.when(F.col("start_year") < F.col("fold"), "train").when(F.col("start_year") == F.col("fold"), "valid")
    return fold.withColumn("role", role).where("role is not null")


def uniform(df: DataFrame) -> DataFrame:
    return df.withColumns({p: F.lit(1 / 3) for p in TRIPLE})


def empirical(train: DataFrame, df: DataFrame, keys: list[str]) -> DataFrame:
    """Class shares of the training rows; uniform without any."""
    shares = train.groupBy(*keys).agg(*[F.avg((F.col("result_code") == c).cast("double")).alias(p) for c, p in enumerate(TRIPLE)])
    return df.join(shares, keys, "left").fillna(1 / 3, TRIPLE)


def normalised(df: DataFrame, strict: bool = False) -> DataFrame:
    """Triples divided by their sums; a sum of 0 or less gives thirds, or an error where strict."""
    every = sum((F.coalesce(F.col(p), F.lit(0.0)) for p in TRIPLE), F.lit(0.0))
    if strict:
        df = df.where(F.assert_true(every > 0, F.lit("probabilities sum to 0")).isNull())
    return df.withColumns({p: F.when(every > 0, F.coalesce(F.col(p), F.lit(0.0)) / every).otherwise(1 / 3) for p in TRIPLE})


def out_of_sample(made: DataFrame, computed: DataFrame, keys: list[str]) -> DataFrame:
    """computed (keys, match_id, source, result_code and a triple) with the stored prediction of a contest in place of the computed one, where there is one.

    made: match_id, created_at, run and a triple; of several the newest counts. What was predicted beforehand is the
    stronger evidence; computed ones stand in where nothing was stored.
    """
    newest = made.groupBy("match_id").agg(F.max_by(F.struct(*TRIPLE), F.struct("created_at", "run")).alias("made"))
    out = computed.join(large(newest), "match_id", "left")
    source = F.when(F.col("made").isNotNull(), "stored").otherwise(F.col("source")).alias("source")
    return out.select(*keys, "match_id", source, "result_code", *[F.coalesce(f"made.{p}", p).alias(p) for p in TRIPLE])


def of_class(code: Column) -> Column:
    return F.when(code == 0, F.col("p_away")).when(code == 1, F.col("p_draw")).otherwise(F.col("p_home"))


def metrics(predictions: DataFrame, keys: list[str]) -> DataFrame:
    """One row a group: n, accuracy, log loss, Brier, precision, recall, F1, confusion and draw statistics, in one pass."""
    y, pred = F.col("result_code"), argmax_class(*map(F.col, TRIPLE))
    p = predictions.withColumn("pred", pred)
    hit = lambda c: (y == c).cast("double")
    square = [(F.col(t) - hit(c)) * (F.col(t) - hit(c)) for c, t in enumerate(TRIPLE)]
    counts = {f"c{i}{j}": F.count_if((y == i) & (F.col("pred") == j)) for i in CLASSES for j in CLASSES}
    out = p.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.avg((y == F.col("pred")).cast("double")).alias("accuracy"),
        F.avg(-F.ln(F.least(F.greatest(of_class(y), F.lit(EPSILON)), F.lit(1.0)))).alias("log_loss"),
        F.avg(square[0] + square[1] + square[2]).alias("brier"),
        *[F.avg(square[c]).alias(f"brier_{name}") for c, name in CLASSES.items()],
        *[c.alias(n) for n, c in counts.items()],
        F.avg("p_draw").alias("draw_mean"), F.median("p_draw").alias("draw_median"), F.min("p_draw").alias("draw_min"), F.max("p_draw").alias("draw_max"),
        F.avg((F.col("pred") == 1).cast("double")).alias("draw_argmax_share"),
        F.avg(F.when(y == 1, F.col("p_draw"))).alias("draw_mean_when_draw"), F.avg(F.when(y != 1, F.col("p_draw"))).alias("draw_mean_when_not"),
    )
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    for c, name in CLASSES.items():
        true = F.col(f"c{c}{c}")
        out = out.withColumn(f"precision_{name}", ratio(true, sum((F.col(f"c{i}{c}") for i in CLASSES), F.lit(0)))).withColumn(f"recall_{name}", ratio(true, sum((F.col(f"c{c}{j}") for j in CLASSES), F.lit(0))))
        a, b = F.col(f"precision_{name}"), F.col(f"recall_{name}")
        out = out.withColumn(f"f1_{name}", ratio(2 * a * b, a + b))
    return out.withColumns({f"{m}_macro": (F.col(f"{m}_away") + F.col(f"{m}_draw") + F.col(f"{m}_home")) / 3 for m in ("precision", "recall", "f1")})


def over_folds(scores: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """Mean, median, standard deviation (0 for one fold), least and most of each metric over folds."""
    stats = lambda c: [F.avg(c).alias(f"{c}_mean"), F.median(c).alias(f"{c}_median"), F.coalesce(F.stddev_samp(c), F.lit(0.0)).alias(f"{c}_std"), F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max")]
    return scores.groupBy(*keys).agg(*[x for c in names for x in stats(c)])


def selected(summary: DataFrame, keys: list[str]) -> DataFrame:
    """The model of least (mean, median, deviation) log loss."""
    return summary.groupBy(*keys).agg(F.min_by("model", F.struct("log_loss_mean", "log_loss_median", "log_loss_std", "model")).alias("model"))


def folds_won(scores: DataFrame, order: list[str]) -> DataFrame:
    """How many folds each model wins; ties go to the first in order."""
    place = F.array_position(F.array(*[F.lit(m) for m in order]), F.col("model"))
    best = scores.groupBy("competition_id", "fold").agg(F.min_by("model", F.struct("log_loss", place)).alias("model"))
    return best.groupBy("model").agg(F.count("*").alias("folds_won"))


def reliability_bins(predictions: DataFrame, keys: list[str], p: str, hit: Column, bins: int = 10) -> DataFrame:
    """Equal-width bins with rows; the last one is closed."""
    b = F.least(F.floor(F.col(p) * bins), F.lit(bins - 1)).cast("int")
    return predictions.withColumn("bin", b).groupBy(*keys, "bin").agg(F.count("*").alias("n"), F.avg(p).alias("mean_predicted"), F.avg(hit.cast("double")).alias("mean_observed"))


def reliability_table(predictions: DataFrame, keys: list[str], p: str, hit: Column, width: float = 0.05, least: int = 30) -> DataFrame:
    """Bins of a width, neighbours merged from the left until each has `least` rows; a rest joins the last.

    Rows are summed by bin first; the fold then runs over at most 1 / width entries a group.
    """
    edge = lambda x: F.floor(F.round(x / F.lit(width), 9))
    w = W.partitionBy(*keys)
    lo, hi = F.min(p).over(w), F.max(p).over(w)
    last = F.greatest(F.ceil(F.round(hi / F.lit(width), 9)), edge(lo) + 1) - 1
    binned = predictions.withColumn("bin", F.least(edge(F.col(p)), last))
    sums = binned.groupBy(*keys, "bin").agg(F.count("*").alias("n"), F.sum(p).alias("sp"), F.sum(hit.cast("double")).alias("sy"))
    entry = "struct<lo:bigint,hi:bigint,n:bigint,sp:double,sy:double>"
    item = F.struct(F.col("bin").alias("lo"), F.col("bin").alias("hi"), "n", "sp", "sy")
    listed = sums.groupBy(*keys).agg(F.sort_array(F.collect_list(item)).alias("bins"))

    def join(a: Column, b: Column) -> Column:
        return F.struct(a["lo"].alias("lo"), b["hi"].alias("hi"), (a["n"] + b["n"]).alias("n"), (a["sp"] + b["sp"]).alias("sp"), (a["sy"] + b["sy"]).alias("sy"))

    def step(state: Column, x: Column) -> Column:
        open_bin = F.when(state["open"].isNull(), x).otherwise(join(state["open"], x))
        full = open_bin["n"] >= least
        return F.struct(F.when(full, F.concat(state["done"], F.array(open_bin))).otherwise(state["done"]).alias("done"), F.when(~full, open_bin).alias("open"))

    start = F.struct(F.array().cast(f"array<{entry}>").alias("done"), F.lit(None).cast(entry).alias("open"))
    folded = listed.withColumn("f", F.aggregate("bins", start, step))
    done, rest, n = F.col("f.done"), F.col("f.open"), F.size("f.done")
    merged = F.when(rest.isNull(), done).when(n == 0, F.array(rest)).otherwise(F.concat(F.slice(done, F.lit(1), n - 1), F.array(join(F.element_at(done, -1), rest))))
    rows = folded.select(*keys, F.explode(merged).alias("b"))
    mean = lambda c: F.col(f"b.{c}") / F.col("b.n")
    return rows.select(*keys, (F.col("b.lo") * width).alias("lo"), ((F.col("b.hi") + 1) * width).alias("hi"), F.col("b.n").alias("n"), mean("sp").alias("mean_predicted"), mean("sy").alias("mean_observed"), (mean("sy") - mean("sp")).alias("difference"))


def class_summary(predictions: DataFrame, keys: list[str]) -> DataFrame:
    """Of each class: mean predicted, frequency, gap, Brier, range and share of argmax; one scan, three rows a prediction."""
    pred = argmax_class(*map(F.col, TRIPLE))
    classes = F.explode(F.array(*[F.struct(F.lit(name).alias("class"), F.col(t).alias("p"), (F.col("result_code") == c).cast("double").alias("hit"), (pred == c).cast("double").alias("top")) for (c, name), t in zip(CLASSES.items(), TRIPLE)]))
    rows = predictions.select(*keys, classes.alias("x")).select(*keys, "x.*")
    return rows.groupBy(*keys, "class").agg(
        F.count("*").alias("n"), F.avg("p").alias("mean_predicted"), F.avg("hit").alias("frequency"), (F.avg("hit") - F.avg("p")).alias("difference"),
        F.avg((F.col("p") - F.col("hit")) * (F.col("p") - F.col("hit"))).alias("brier"), F.min("p").alias("least"), F.max("p").alias("most"), F.avg("top").alias("argmax_share"),
    )


def verdict(difference: Column) -> Column:
    return F.when(F.abs(difference) <= 0.015, "well_calibrated").when(difference > 0, "underpredicted").otherwise("overpredicted")


def blend(predictions: DataFrame, weights: DataFrame, keys: list[str]) -> DataFrame:
    """Weighted means of the models' triples (weights: candidate, model, weight); keys name a contest's prediction."""
    mixed = predictions.join(F.broadcast(weights), "model")  # a fixed list of candidates
    out = mixed.groupBy("candidate", *keys).agg(*[(F.sum(F.greatest(F.col(p), F.lit(0.0)) * F.col("weight")) / F.sum("weight")).alias(p) for p in TRIPLE])
    return normalised(out).withColumnRenamed("candidate", "model")


def blend_by(predictions: DataFrame, weights: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """The same with weights of their own for each fold and competition (by): candidate, model, by, weight."""
    mixed = predictions.join(weights, ["model", *by])
    out = mixed.groupBy("candidate", *keys).agg(*[(F.sum(F.greatest(F.col(p), F.lit(0.0)) * F.col("weight")) / F.sum("weight")).alias(p) for p in TRIPLE])
    return normalised(out).withColumnRenamed("candidate", "model")


def place(key: str, *order) -> Column:
    return F.row_number().over(W.partitionBy(key).orderBy(*order))


def inverse_loss_weights(scores: DataFrame) -> DataFrame:
    """For each fold and model 1 / the mean loss of the other folds, normalised over models."""
    w = W.partitionBy("competition_id", "model")
    others = (F.sum("log_loss").over(w) - F.col("log_loss")) / (F.count("*").over(w) - 1)
    raw = scores.select("competition_id", "fold", "model", (1 / F.nullif(others, F.lit(0.0))).alias("raw"))
    return raw.withColumn("weight", F.col("raw") / F.sum("raw").over(W.partitionBy("competition_id", "fold"))).drop("raw")


def recommendation(production: Column, winner: Column, wf_gain: Column, holdout_gain: Column, complex_models: list[str]) -> Column:
    """Keep, insufficient or switch; a more complex winner needs twice the gain."""
    harder = winner.isin(complex_models) & ~production.isin(complex_models)
    need = F.when(harder, 0.010).otherwise(0.005)
    return F.when(winner == production, "KEEP CURRENT PRODUCTION").when((wf_gain < need) | holdout_gain.isNull() | (holdout_gain < need), "INSUFFICIENT IMPROVEMENT").otherwise("SWITCH TO NEW MODEL")


def scorecard(settled: DataFrame, keys: list[str]) -> DataFrame:
    """Accuracy and clipped, renormalised log loss of stored predictions; nulls for an empty group."""
    clip = lambda c: F.least(F.greatest(c, F.lit(1e-15)), F.lit(1.0))
    every = clip(F.col("p_away")) + clip(F.col("p_draw")) + clip(F.col("p_home"))
    right = F.col("predicted_class") == F.col("result_code")
    rate = lambda k, c: F.avg(F.when(F.col(k) == c, right.cast("double")))
    return settled.groupBy(*keys).agg(
        F.count("*").alias("n"), F.count_if(right).alias("correct"), F.avg(right.cast("double")).alias("accuracy"),
        F.avg(-F.ln(clip(of_class(F.col("result_code"))) / every)).alias("log_loss"),
        *[rate("result_code", c).alias(f"rate_actual_{n}") for c, n in CLASSES.items()],
        *[rate("predicted_class", c).alias(f"rate_predicted_{n}") for c, n in CLASSES.items()],
    )
