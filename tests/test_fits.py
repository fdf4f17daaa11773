"""Models of many groups beside fits of one group at a time."""

import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from contestry.operators import fits

WIDTH = 5
NAMES = [f"f{i}" for i in range(WIDTH)]
SCHEMA = "fold int, role string, match_id long, result_code int, " + ", ".join(f"{n} double" for n in NAMES)


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1.0, steps: int = 50) -> np.ndarray:
    """Multinomial weights (features and intercept x 3) by Newton's steps; the intercepts aren't penalised."""
    x = np.column_stack([x, np.ones(len(x))])
    n, k = x.shape[1], 3
    w, hot = np.zeros((n, k)), np.eye(k)[y]
    ridge = np.diag(np.repeat(np.append(np.full(n - 1, penalty), 1e-6), k))
    for _ in range(steps):
        p = x @ w
        p = np.exp(p - p.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        g = x.T @ (weight[:, None] * (p - hot)) + np.diag(ridge).reshape(n, k) * w
        h = np.zeros((n, k, n, k))
        for a in range(k):
            for b in range(k):
                h[:, a, :, b] = x.T @ (x * (weight * p[:, a] * ((a == b) - p[:, b]))[:, None])
        step = np.linalg.solve(h.reshape(n * k, n * k) + ridge, g.ravel()).reshape(n, k)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


def made(spark):
    """Two folds of 400 rows; in the third no training row is drawn, in the fourth there is nothing to train on."""
    r, out = np.random.default_rng(5), []
    for fold, n in ((1, 400), (2, 300), (3, 120), (4, 5)):
        x = r.normal(size=(n, WIDTH)).round(2)
        score = x[:, 0] - 0.5 * x[:, 1] + (x[:, 2] > 0.3) * 1.5 + r.normal(size=n)
        y = np.digitize(score, [-0.5, 0.6])
        y = np.where(y == 1, 2, y) if fold == 3 else y
        for i in range(n):
            v = [None if r.random() < 0.05 else float(a) for a in x[i]]
            out.append((fold, "valid" if i % 4 == 0 or fold == 4 else "train", fold * 10_000 + i, int(y[i]), *v))
    return spark.createDataFrame(out, SCHEMA)


@pytest.fixture(scope="module")
def built(spark):
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(fits, "BLOCK", 70)
        rows = made(spark)
        ready = fits.stored(fits.applied(rows, fits.statistics(rows, ["fold"], NAMES), ["fold"], NAMES), "prepared")
        yield rows, ready, fits.stored(fits.packed(ready, ["fold"]), "blocks")


def arrays(ready, fold, role):
    rows = sorted(ready.where(F.col("fold") == fold).where(F.col("role") == role).collect(), key=lambda r: r.match_id)
    return np.array([r.x for r in rows]), np.array([r.bins for r in rows], np.uint8), np.array([r.result_code for r in rows]), np.array([r.match_id for r in rows])


def triples(found, fold):
    return np.array([[r.p_away, r.p_draw, r.p_home] for r in sorted(found, key=lambda r: r.match_id) if r.fold == fold])


def test_rows_are_scaled_and_packed(spark, built):
    rows, ready, blocks = built
    x, bins, y, _ = arrays(ready, 1, "train")
    assert np.allclose(x.mean(0), 0) and np.allclose(x.std(0), 1) and bins.max() == fits.BINS - 1
    raw = np.array([r[4] if r[4] is not None else np.nan for r in sorted(rows.where("fold = 1 and role = 'train'").collect(), key=lambda r: r.match_id)], float)
    order = np.argsort(raw)[: len(raw) - np.isnan(raw).sum()]
    assert (np.diff(bins[order, 0].astype(int)) >= 0).all()
    assert blocks.where("fold = 1 and role = 'train'").count() > 3
    assert {r.fold: r.reason for r in fits.unfitted(rows, ["fold"]).collect()} == {4: "no training rows"}


@pytest.mark.parametrize("balanced", [False, True])
def test_logistic_regression_is_that_of_each_group(built, balanced):
    _, ready, blocks = built
    models = fits.logistic(blocks, ["fold"], WIDTH, balanced)
    found = fits.predicted(blocks, models, ["fold"], fits.logistic_triples).collect()
    for fold in (1, 2):
        x, _, y, _ = arrays(ready, fold, "train")
        w = fit_logistic(x, y, len(y) / (3 * np.bincount(y, minlength=3)[y]) if balanced else np.ones(len(y)))
        given = arrays(ready, fold, "valid")[0]
        assert np.allclose(triples(found, fold), fits.softmax(np.column_stack([given, np.ones(len(given))]) @ w), atol=1e-6)
    two = triples(found, 3)  # a fold without draws
    assert len(two) == 30 and (two[:, 1] == 0).all() and np.allclose(two.sum(1), 1) and not triples(found, 4).size


def boosted_alone(bins, y, given, rounds):
    """The same trees by looking at every split of every node."""
    n, k = len(y), 3
    m, mg = np.zeros((n, k)), np.zeros((len(given), k))

    def split(rows, g, h):
        best = (1e-9, None)
        base = g[rows].sum() ** 2 / (h[rows].sum() + 1)
        for f in range(bins.shape[1]):
            for b in range(fits.BINS - 1):
                left = rows & (bins[:, f] <= b)
                right = rows & (bins[:, f] > b)
                if h[left].sum() >= 1 and h[right].sum() >= 1:
                    gain = g[left].sum() ** 2 / (h[left].sum() + 1) + g[right].sum() ** 2 / (h[right].sum() + 1) - base
                    if gain > best[0] + 1e-12:
                        best = (gain, (f, b))
        return best[1]

    for _ in range(rounds):
        p = fits.softmax(m)
        add, addg = np.zeros_like(m), np.zeros_like(mg)
        for c in range(k):
            g, h = p[:, c] - (y == c), np.maximum(2 * p[:, c] * (1 - p[:, c]), 1e-16)

            def grow(rows, grows, depth):
                s = split(rows, g, h) if depth else None
                if s is None:
                    value = -0.1 * g[rows].sum() / (h[rows].sum() + 1)
                    add[rows, c], addg[grows, c] = value, value
                    return
                grow(rows & (bins[:, s[0]] <= s[1]), grows & (given[:, s[0]] <= s[1]), depth - 1)
                grow(rows & (bins[:, s[0]] > s[1]), grows & (given[:, s[0]] > s[1]), depth - 1)

            grow(np.ones(n, bool), np.ones(len(given), bool), 2)
        m, mg = m + add, mg + addg
    return fits.softmax(mg)


def test_boosted_trees_are_those_of_every_split(built):
    _, ready, blocks = built
    models = fits.boosted(blocks, ["fold"], WIDTH, rounds=3)
    found = fits.predicted(blocks, models, ["fold"], fits.boosted_triples).collect()
    for fold in (1, 2):
        _, bins, y, _ = arrays(ready, fold, "train")
        wanted = boosted_alone(bins, y, arrays(ready, fold, "valid")[1], 3)
        assert np.allclose(triples(found, fold), wanted, atol=1e-9)
    assert (triples(found, 3)[:, 1] == 0).all()


def test_forest_is_that_of_each_tree_alone(built):
    _, ready, blocks = built
    trees = 4
    found = fits.predicted(blocks, fits.forest(blocks, ["fold"], WIDTH, trees), ["fold"], fits.forest_triples(trees)).collect()
    _, bins, y, ids = arrays(ready, 2, "train")
    given, out = arrays(ready, 2, "valid")[1], 0
    balance = len(y) / (3 * np.bincount(y, minlength=3)[y])
    for t in range(trees):
        w = fits.draws(ids, trees)[:, t] * balance
        p = np.zeros((len(given), 3))

        def grow(rows, grows, node, depth):
            shares = np.array([w[rows & (y == c)].sum() for c in range(3)])
            best = (np.inf, None)
            gini = lambda at: (s := np.array([w[at & (y == c)].sum() for c in range(3)])).sum() - (s**2).sum() / max(s.sum(), 1e-12)
            for f in fits.tried(t, node, WIDTH) if depth else ():
                for b in range(fits.BINS - 1):
                    left, right = rows & (bins[:, f] <= b), rows & (bins[:, f] > b)
                    if w[left].sum() > 0 and w[right].sum() > 0 and gini(left) + gini(right) < best[0] - 1e-12:
                        best = (gini(left) + gini(right), (f, b))
            if best[1] is None:
                p[grows] = shares / max(shares.sum(), 1e-12)
                return
            f, b = best[1]
            grow(rows & (bins[:, f] <= b), grows & (given[:, f] <= b), 2 * node + 1, depth - 1)
            grow(rows & (bins[:, f] > b), grows & (given[:, f] > b), 2 * node + 2, depth - 1)

        grow(np.ones(len(y), bool), np.ones(len(given), bool), 0, 3)
        out = out + p
    assert np.allclose(triples(found, 2), out / out.sum(1, keepdims=True), atol=1e-9)


def test_a_bootstrap_takes_each_row_once_on_average():
    drawn = fits.draws(np.arange(20_000), 20)
    assert abs(drawn.mean() - 1) < 0.01 and abs(drawn.var() - 1) < 0.02 and (drawn[5] == fits.draws(np.array([5]), 20)).all()


@pytest.mark.parametrize("algorithm", ["logistic_regression_balanced", "random_forest"])
def test_stored_models_score_like_fresh_ones(spark, algorithm, monkeypatch):
    from contestry.operators import learn
    from contestry.sources.versioned import fresh_table

    monkeypatch.setattr(fits, "BLOCK", 150)
    r, rows = np.random.default_rng(3), []
    for i in range(500):
        v = r.normal(size=len(learn.FEATURES)).round(2)
        y = int(np.digitize(v[0] + r.normal(), [-0.5, 0.5]))
        rows.append((i % 2, "valid" if i >= 440 else "train", i, y, *[None if r.random() < 0.03 else float(x) for x in v]))
    rows = spark.createDataFrame(rows, "league int, role string, match_id long, result_code int, " + ", ".join(f"{f} double" for f in learn.FEATURES))
    fresh = learn.walk_forward(rows, ["league"], (algorithm,))
    table = fresh_table(spark, "models", ["league"], ["league"])
    table.replace(learn.trained(rows.where("role = 'train'").drop("role"), ["league"], algorithm))
    found = learn.score(rows.where("role = 'valid'").drop("role", "result_code"), table.read(), ["league"], algorithm)
    columns = ["league", "match_id", "p_away", "p_draw", "p_home"]
    shown = lambda df: sorted(tuple(round(x, 9) for x in r) for r in df.select(*columns).collect())
    assert shown(found) == shown(fresh) and found.count() == 60


def pooled(spark):
    from contestry.operators import learn

    r = np.random.default_rng(11)
    rows = [(i, i % 3, *(float(x) for x in r.normal(size=len(learn.FEATURES)).round(2) + i % 3)) for i in range(90)]
    return spark.createDataFrame(rows, "match_id long, result_code int, " + ", ".join(f"{f} double" for f in learn.FEATURES))


def test_boosted_classes_are_fitted_side_by_side(spark, monkeypatch):
    from contestry.operators import learn

    made, met = learn.GBTClassifier, threading.Barrier(3)

    def gbt(**given):
        met.wait(20)  # all three classes are under way
        return made(**{**given, "maxIter": 2})

    monkeypatch.setattr(learn, "GBTClassifier", gbt)
    rows = pooled(spark)
    found = learn.fit_predict("boosted", rows, rows).collect()
    assert len(found) == 90 and all(abs(r.p_away + r.p_draw + r.p_home - 1) < 1e-9 for r in found)
    assert sum(max(range(3), key=lambda c: (r.p_away, r.p_draw, r.p_home)[c]) == r.result_code for r in found) > 60


def test_medians_only_of_features_that_lack_values(spark, monkeypatch):
    from contestry.operators import learn

    rows, asked, median = pooled(spark), [], learn.F.median
    a, b, c = learn.FEATURES[:3]
    other = rows.withColumn(a, F.when(F.col("match_id") > 3, F.col(a))).withColumn(b, F.when(F.col("match_id") == 5, F.lit(float("nan"))).otherwise(F.col(b)))
    monkeypatch.setattr(learn.F, "median", lambda c: asked.append(c) or median(c))
    filled, same = learn.impute(rows, other, rows)
    assert sorted(asked) == sorted([a, b])
    middle = rows.agg(median(a), median(b)).first()
    got, old = {r.match_id: r for r in filled.collect()}, {r.match_id: r for r in rows.collect()}
    assert all(got[i][a] == (middle[0] if i <= 3 else old[i][a]) and got[i][b] == (middle[1] if i == 5 else old[i][b]) and got[i][c] == old[i][c] for i in old)
    assert same.collect() == rows.collect()
