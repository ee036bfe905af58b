"""Factorization machine, ALS, search, evaluation and flows: brute force and invariants."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sitrec.models import als, evaluate, fm, fm_fit, learners, search
from sitrec.models.fm import CLASSIFICATION, FMModel
from sitrec.models.fm_fit import FMSettings
from sitrec.operators.encoding import assemble, encode, feature_dictionary, index_table
from sitrec.plans import recommend, stages
from sitrec.sources.features import long_features
from sitrec.storage import new_path

N, K = 12, 3


def random_rows(count=80, seed=1):
    """Sparse rows with real values whose label has a pairwise part."""
    rng = np.random.default_rng(seed)
    w, v = rng.normal(0, 0.3, N), rng.normal(0, 0.5, (N, K))
    rows = []
    for r in range(count):
        idx = sorted(rng.choice(N, size=rng.integers(1, 5), replace=False).tolist())
        val = rng.normal(1, 0.3, len(idx)).tolist()
        rows.append((r, direct(0.1, w, v, idx, val) + float(rng.normal(0, 0.01)), idx, val))
    return rows


def direct(w0, w, v, idx, val):
    """The score by its definition, a sum over all pairs."""
    score = w0 + sum(w[i] * x for i, x in zip(idx, val))
    for a in range(len(idx)):
        for b in range(a + 1, len(idx)):
            score += float(v[idx[a]] @ v[idx[b]]) * val[a] * val[b]
    return float(score)


def frame(spark, rows):
    return spark.createDataFrame(rows, "row_id bigint, label double, idx array<bigint>, val array<double>")


def model_of(spark, w0, w, v, **kind):
    rows = [(i, float(w[i]), *map(float, v[i])) for i in range(len(w))]
    factors = spark.createDataFrame(rows, "idx bigint, w double, " + ", ".join(f"v{f} double" for f in range(v.shape[1])))
    return FMModel(factors, w0, len(w), v.shape[1], **{"low": -9.0, "high": 9.0, **kind})


def parameters(seed=3):
    rng = np.random.default_rng(seed)
    return 0.2, rng.normal(0, 0.4, N), rng.normal(0, 0.4, (N, K))


# ---- scoring -----------------------------------------------------------------------------------


@pytest.mark.parametrize("limit", [1 << 30, -1])
def test_scores_equal_the_definition(spark, limit):
    rows, (w0, w, v) = random_rows(), parameters()
    long = long_features(frame(spark, rows), "row_id")
    model = model_of(spark, w0, w, v)
    got = {r.row_id: r.raw for r in fm.score_sums(long, model, broadcast_bytes=limit).collect()}
    for row_id, _, idx, val in rows:
        assert got[row_id] == pytest.approx(direct(w0, w, v, idx, val))


def test_links(spark):
    rows, (w0, w, v) = random_rows(20), parameters()
    long = long_features(frame(spark, rows), "row_id")
    clamped = fm.score_long(long, model_of(spark, w0, w, v, low=-0.1, high=0.1))
    assert all(-0.1 <= r.prediction <= 0.1 for r in clamped.collect())
    odds = fm.score_long(long, model_of(spark, w0, w, v, task=CLASSIFICATION))
    assert all(0.0 < r.prediction < 1.0 for r in odds.collect())


def test_gradient_is_the_finite_difference(spark):
    rows, (w0, w, v) = random_rows(), parameters()
    data = long_features(frame(spark, rows), "row_id", "label")
    model = model_of(spark, w0, w, v)
    slopes = fm.row_slopes(data, model)
    seen = fm.mean_loss(slopes).first()
    table = {r.idx: r for r in fm.gradient(data, slopes, model, seen.n).collect()}

    def loss(w0, w, v):
        return sum((direct(w0, w, v, i, x) - y) ** 2 / 2 for _, y, i, x in rows) / len(rows)

    assert seen.loss == pytest.approx(loss(w0, w, v))
    h = 1e-6
    assert seen.dw0 == pytest.approx((loss(w0 + h, w, v) - loss(w0 - h, w, v)) / (2 * h), abs=1e-5)
    for i in (0, 5, 11):
        e = np.zeros(N)
        e[i] = h
        assert table[i].dw == pytest.approx((loss(w0, w + e, v) - loss(w0, w - e, v)) / (2 * h), abs=1e-5)
        for f in range(K):
            m = np.zeros((N, K))
            m[i, f] = h
            want = (loss(w0, w, v + m) - loss(w0, w, v - m)) / (2 * h)
            assert table[i][f"dv{f}"] == pytest.approx(want, abs=1e-5)


@pytest.mark.parametrize("task", ["regression", "classification"])
def test_compact_and_table_gradients_agree(spark, task):
    rows, (w0, w, v) = random_rows(), parameters()
    rows.append((999, 0.3, [], []))
    settings = FMSettings(task=task, dim=(True, True, K), reg=(0.1, 0.2, 0.3))
    data = frame(spark, rows).select("label", "idx", "val").repartition(3)
    compact = fm_fit.CompactSpace(data, N, K, -9.0, 9.0)
    x = np.append(np.column_stack([w, v]).ravel(), w0)
    loss, grad = compact.evaluate([(x, settings)])[0]

    table = fm_fit.TableSpace(data, N, K, -9.0, 9.0)
    given = spark.createDataFrame(
        [(i, [float(w[i]), *map(float, v[i])]) for i in range(N)] + [(-1, [w0] + [0.0] * K)], "idx bigint, x0 array<double>"
    )
    table._store(given)
    same_loss, g = table.evaluate([("x0", settings)])[0]
    found = {r.idx: r[g] for r in table.state.collect()}
    assert same_loss == pytest.approx(loss)
    assert found[-1][0] == pytest.approx(grad[-1])
    for i in range(N):
        assert found[i] == pytest.approx(grad[:-1].reshape(N, K + 1)[i].tolist())
    assert table.gram(["x0", g])[0, 1] == pytest.approx(float(x @ grad))


@pytest.mark.parametrize("task", ["regression", "classification"])
def test_vectors_in_the_shared_folder(spark, task, monkeypatch):
    """Vectors that do not go through the driver: the same model and errors; only the vectors in use stay."""
    monkeypatch.setattr(fm_fit, "PIECE", 4)
    rows = frame(spark, [*random_rows(60), (990, 0.4, [], []), (991, -0.2, [], [])]).repartition(3).persist()
    points = [FMSettings(task=task, iterations=4, dim=(b, w, 2), reg=(0.1, 0.01, 0.01), init_std=0.1) for b, w in ((True, True), (False, False))]
    plain, errors = fm_fit.fm_train_points(rows, N, points), fm_fit.fm_validate_points(rows, rows, N, points)
    stepped = fm_fit.fm_train_sgd(rows, N, points[0])
    monkeypatch.setattr(fm_fit, "DRIVER_BYTES", 0)

    def unused(self, task):
        raise AssertionError("vectors on the driver")

    monkeypatch.setattr(fm_fit.CompactSpace, "start", unused)
    assert fm_fit.fm_validate_points(rows, rows, N, points) == pytest.approx(errors)
    shared = [*fm_fit.fm_train_points(rows, N, points), fm_fit.fm_train_sgd(rows, N, points[0])]
    for a, b in zip([*plain, stepped], shared):
        assert a.intercept == pytest.approx(b.intercept, abs=1e-9)
        for x, y in zip(a.factors.orderBy("idx").collect(), b.factors.orderBy("idx").collect(), strict=True):
            assert x == pytest.approx(y, abs=1e-9)


def test_sums_come_back_once(spark, monkeypatch):
    """However many tasks there are, one row of each piece reaches the driver."""
    monkeypatch.setattr(fm_fit, "SUMS_LONG", 5)
    space = fm_fit.CompactSpace(frame(spark, random_rows(60)).select("label", "idx", "val").repartition(12), N, K, -9.0, 9.0)
    x, sizes, whole = np.full(N * (K + 1) + 1, 0.1), [], type(space.rows).toArrow

    def counted(df):
        found = whole(df)
        sizes.append((found.num_rows, len(set(found["at"].to_pylist()))))
        return found

    monkeypatch.setattr(type(space.rows), "toArrow", counted)
    space.evaluate([(x, FMSettings(dim=(True, True, K)))])
    pieces = -(-(N * (K + 1) + 3) // 5)
    assert sizes == [(pieces, pieces)]


def test_sgd_forms_give_one_model(spark):
    rows = frame(spark, [*random_rows(60), (990, 0.4, [], [])]).repartition(2).persist()
    seen: list[list[float]] = [[], []]
    settings = FMSettings(iterations=3, dim=(True, True, 2), reg=(0.1, 0.01, 0.02), init_std=0.1)
    a, b = (
        fm_fit.fm_train_sgd(rows, N, settings, step=0.5, report=lambda t, loss, j=j: seen[j].append(loss), compact_bytes=limit)
        for j, limit in enumerate((1 << 30, 0))
    )
    assert seen[0] == pytest.approx(seen[1]) and a.intercept == pytest.approx(b.intercept)
    for x, y in zip(a.factors.orderBy("idx").collect(), b.factors.orderBy("idx").collect(), strict=True):
        assert x == pytest.approx(y, abs=1e-9)


def test_switched_off_parts_stay_zero(spark):
    settings = FMSettings(iterations=3, dim=(False, False, 2), init_std=0.1)
    model = fm_fit.fm_train_lbfgs(frame(spark, random_rows()), N, settings)
    assert model.intercept == 0.0
    assert all(r.w == 0.0 for r in model.factors.collect())


# ---- training ----------------------------------------------------------------------------------


def test_lbfgs_on_a_quadratic():
    class Space:
        a = np.diag([1.0, 10.0, 100.0])

        def evaluate(self, points):
            return [(float(x @ self.a @ x / 2 - x.sum()), self.a @ x - 1.0) for x, _ in points]

        def gram(self, basis):
            return np.vstack(basis) @ np.vstack(basis).T

        def combine(self, coefficients, vectors):
            return sum(c * v for c, v in zip(coefficients, vectors))

        def keep(self, vectors):
            pass

    x = fm_fit.minimise(Space(), np.zeros(3), FMSettings(iterations=50, tolerance=0.0))
    assert np.allclose(x, [1.0, 0.1, 0.01], atol=1e-5)


def rmse_of(spark, model, rows):
    return search.fm_rmse(model, frame(spark, rows))


@pytest.mark.parametrize("limit", [1 << 30, 0])
def test_lbfgs_beats_the_mean(spark, limit):
    rows = random_rows(200)
    settings = FMSettings(iterations=40 if limit else 12, dim=(True, True, K), reg=(0.0, 0.0, 0.0), init_std=0.1)
    model = fm_fit.fm_train_lbfgs(frame(spark, rows), N, settings, compact_bytes=limit)
    labels = np.array([r[1] for r in rows])
    assert rmse_of(spark, model, rows) < 0.5 * labels.std()
    assert (model.low, model.high) == (labels.min(), labels.max())


def test_same_seed_same_model(spark):
    rows, settings = frame(spark, random_rows()).repartition(2).persist(), FMSettings(iterations=3, dim=(True, True, 2), seed=4)
    a, b = (fm_fit.fm_train_lbfgs(rows, N, settings) for _ in range(2))
    for x, y in zip(a.factors.orderBy("idx").collect(), b.factors.orderBy("idx").collect()):
        assert x == pytest.approx(y)


@pytest.mark.parametrize("task", ["regression", "classification"])
def test_both_forms_give_one_model(spark, task):
    rows = [*random_rows(60), (990, 0.4, [], []), (991, -0.2, [], [])]
    settings = FMSettings(task=task, iterations=4, dim=(True, True, 2), reg=(0.1, 0.01, 0.01), init_std=0.1, seed=3)
    a, b = (fm_fit.fm_train_lbfgs(frame(spark, rows), N, settings, compact_bytes=limit) for limit in (1 << 30, 0))
    assert a.intercept == pytest.approx(b.intercept, abs=1e-9)
    for x, y in zip(a.factors.orderBy("idx").collect(), b.factors.orderBy("idx").collect()):
        assert x == pytest.approx(y, abs=1e-9)


@pytest.mark.parametrize("limit", [1 << 30, 0])
def test_unknown_features_are_refused(spark, limit):
    with pytest.raises(ValueError):
        fm_fit.fm_train_lbfgs(frame(spark, [(1, 0.5, [0, N], [1.0, 1.0])]), N, FMSettings(iterations=1), compact_bytes=limit)


def test_points_side_by_side_equal_single_fits(spark):
    rows = frame(spark, random_rows(80))
    points = [FMSettings(iterations=5, dim=(b, True, 2), init_std=s, reg=(0.0, 0.1, 0.1)) for b in (True, False) for s in (0.05, 0.2)]
    for p, together in zip(points, fm_fit.fm_train_points(rows, N, points)):
        alone = fm_fit.fm_train_lbfgs(rows, N, p)
        assert together.intercept == pytest.approx(alone.intercept)
        for x, y in zip(together.factors.orderBy("idx").collect(), alone.factors.orderBy("idx").collect()):
            assert x == pytest.approx(y)
    errors = fm_fit.fm_validate_points(rows, rows, N, points)
    assert errors[1] == pytest.approx(search.fm_rmse(fm_fit.fm_train_lbfgs(rows, N, points[1]), rows))


def test_points_in_turn_equal_points_side_by_side(spark, monkeypatch):
    """However few descents move at a time; points that differ in what they switch off are one descent."""
    rows = frame(spark, random_rows(60)).repartition(3).persist()
    points = [FMSettings(iterations=5, dim=(b, True, 2), reg=(r, 0.01, 0.01), init_std=0.1) for b in (True, False) for r in (0.0, 0.5)]
    errors, asked, whole = fm_fit.fm_validate_points(rows, rows, N, points), [], fm_fit.CompactSpace.evaluate
    assert errors[0] != errors[1] and errors[2] == errors[3]

    def counted(space, some):
        asked.append(len(some))
        return whole(space, some)

    monkeypatch.setattr(fm_fit.CompactSpace, "evaluate", counted)
    for held, most in ((1 << 30, 3), (1, 1)):
        monkeypatch.setattr(fm_fit, "DESCENT_BYTES", held)
        asked.clear()
        assert fm_fit.fm_validate_points(rows, rows, N, points) == pytest.approx(errors, rel=1e-9)
        assert max(asked) == most
    monkeypatch.setattr(fm_fit, "DRIVER_BYTES", 0)
    assert fm_fit.fm_validate_points(rows, rows, N, points) == pytest.approx(errors, rel=1e-9)


def test_rows_of_one_length_and_others_add_alike():
    """Blocks column by column give the scores and gradients of rows cell by cell, to the last bit where no row is ragged."""
    rng, cells = np.random.default_rng(4), 6
    for n, length, values in ((50, 5, (1.0,)), (50, 1, (0.5, 2.0)), (30, 3, (1.0, -0.5))):
        idx, val = rng.integers(0, cells, (n, length)) + cells * np.arange(length), rng.choice(values, (n, length))
        seen, place = np.unique(idx.ravel(), return_inverse=True)
        y, settings, table = rng.normal(size=n), FMSettings(), rng.normal(size=(cells * length, 9))
        found = []
        for rows in (fm_fit.EvenRows(y, length, seen, place, val.ravel()), fm_fit.RaggedRows(y, np.full(n, length), seen, place, val.ravel())):
            raw, *parts = rows.score(0.1, table)
            grad = np.zeros_like(table)
            rows.add_gradient(grad, fm_fit._slopes(settings, raw, y, -1.0, 1.0)[1], *parts)
            found.append((raw, grad))
        assert all((a == b).all() for a, b in zip(*found))


def test_queries_do_the_whole_job(spark, monkeypatch):
    """``fm_search`` searches all points of the grid, ``fm_lbfgs_table`` has all iterations."""
    from sitrec.checks import machine

    monkeypatch.setattr(machine, "feature_dictionary", lambda df: df)
    for name in ("ratings", "encoded", "scaled"):
        monkeypatch.setattr(machine, name, lambda *args: spark.range(1))
    monkeypatch.setattr(machine.search, "fm_search", lambda rows, n, grid=search.FM_GRID: search.grid_points(grid))
    assert len(machine.fm_search(spark, "")) == 324

    def fitted(rows, n, settings, compact_bytes):
        raise InterruptedError(settings.iterations, compact_bytes)

    monkeypatch.setattr(machine, "fm_train_lbfgs", fitted)
    with pytest.raises(InterruptedError) as asked:
        machine.fm_lbfgs_table(spark, "")
    assert asked.value.args == (100, 0)


def test_rows_without_features_count(spark):
    """Half of the rows have no feature: the intercept learns from them, and they are scored."""
    rows = [(i, 1.0 if i % 2 else 50.0, [0] if i % 2 else [], [1.0] if i % 2 else []) for i in range(10)]
    long = long_features(frame(spark, rows), "row_id", "label", empty=True)
    model = model_of(spark, 0.0, [0.0] * N, np.zeros((N, K)), low=-99.0, high=99.0)
    seen = fm.mean_loss(fm.row_slopes(long, model)).first()
    assert (seen.n, seen.dw0) == (10, -25.5)
    assert fm.score_long(long, model).count() == 10
    stepped = fm_fit.fm_train_sgd(frame(spark, rows), N, FMSettings(iterations=1, dim=(True, False, 1), init_std=0.0, reg=(0.0, 0.0, 0.0)))
    assert stepped.intercept == pytest.approx(25.5)


def test_sgd_lowers_the_loss(spark):
    seen = []
    fm_fit.fm_train_sgd(
        frame(spark, random_rows()),
        N,
        FMSettings(iterations=4, dim=(True, True, 2), init_std=0.1),
        step=0.5,
        fraction=0.9,
        report=lambda t, loss: seen.append(loss),
    )
    assert len(seen) == 4 and seen[-1] < seen[0]


def test_l2_update_by_hand(spark):
    model = model_of(spark, 1.0, [2.0], np.array([[3.0]]))
    grad = spark.createDataFrame([(0, 0.5, 0.25)], "idx bigint, dw double, dv0 double")
    moved, penalty = fm.l2_update(model, grad, 0.1, step=0.4, iteration=4, reg=(0.1, 0.2, 0.3))
    row = moved.factors.first()
    w0, w, v = 1.0 - 0.2 * (0.1 + 0.1), 2.0 - 0.2 * (0.5 + 0.4), 3.0 - 0.2 * (0.25 + 0.9)
    assert (moved.intercept, row.w, row.v0) == pytest.approx((w0, w, v))
    assert penalty.first()[0] == pytest.approx((0.1 * w0**2 + 0.2 * w**2 + 0.3 * v**2) / 2)


def test_settings_are_checked(spark):
    for bad in ({"iterations": 0}, {"dim": (True, True, 0)}, {"reg": (-1.0, 0.0, 0.0)}, {"task": "rank"}):
        with pytest.raises(ValueError):
            FMSettings(**bad)
    with pytest.raises(ValueError):
        fm_fit.fm_train_sgd(frame(spark, random_rows(3)), N, fraction=0.0)
    with pytest.raises(ValueError):
        fm_fit.fm_train_lbfgs(frame(spark, random_rows(3)), 0)
    with pytest.raises(ValueError):
        fm_fit.fm_train_lbfgs(frame(spark, []), N)


# ---- artefacts ---------------------------------------------------------------------------------


def test_model_round_trip_and_checks(spark):
    rows, (w0, w, v) = random_rows(10), parameters()
    model, path = model_of(spark, w0, w, v), new_path(spark, "fm")
    model.save(path)
    back = FMModel.load(spark, path)
    long = long_features(frame(spark, rows), "row_id")
    a, b = (sorted(map(tuple, fm.score_long(long, m).collect())) for m in (model, back))
    assert a == b
    model.with_factors(model.factors.filter("idx > 0")).save(path)
    with pytest.raises(ValueError, match="expected 12 features"):
        FMModel.load(spark, path)
    spark.createDataFrame([("other", "9")], "format string, version string").write.mode("overwrite").json(f"{path}/header")
    with pytest.raises(ValueError, match="holds no"):
        FMModel.load(spark, path)


def test_params_round_trip(spark):
    settings = FMSettings(iterations=7, dim=(False, True, 5), reg=(0.1, 0.0, 1.0), init_std=0.5, clamp_in_training=True)
    path = new_path(spark, "params")
    search.save_params(spark, settings, path)
    assert search.load_params(spark, path) == settings


# ---- search ------------------------------------------------------------------------------------


def test_full_grids():
    assert len(search.grid_points(search.FM_GRID)) == 324
    assert len(search.grid_points(als.GRID)) == 48
    assert len(search.grid_points(learners.LINEAR_GRID)) == 18


def test_best_point(spark):
    rows = [(0, 0, "p0", 0.5), (1, 0, "p0", 0.9), (0, 1, "p1", 0.6), (1, 1, "p1", 0.6), (0, 2, "p2", float("nan")), (1, 2, "p2", None)]
    results = spark.createDataFrame(rows, "fold int, point int, params string, rmse double")
    assert search.best(results).first().params == "p1"
    assert search.best(results, "min_fold").first().params == "p0"
    with pytest.raises(ValueError):
        search.best(results, "max")


# ---- evaluation --------------------------------------------------------------------------------


def test_rmse_leaves_out_missing(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, float("nan")), (1.0, None)], "rating double, prediction double")
    assert evaluate.rmse(df).first() == (pytest.approx(math.sqrt(0.5)), 2, 2)


def test_joined_rmse_denominators(spark):
    truth = spark.createDataFrame([("u", "a", 1.0), ("u", "a", 3.0), ("u", "b", 2.0)], "userid string, itemid string, rating double")
    known = spark.createDataFrame([("u", "a", 2.0)], "userid string, itemid string, prediction double")
    assert evaluate.rmse_joined(known, truth).first()[0] == pytest.approx(1.0)
    assert evaluate.rmse_joined(known, truth, denominator="all").first()[0] == pytest.approx(math.sqrt(2 / 3))
    empty = known.filter("false")
    assert evaluate.rmse_joined(empty, truth).first() == (None, 0)


def test_auc_with_ties(spark):
    rng = np.random.default_rng(2)
    data = [(float(s), bool(p)) for s, p in zip(rng.integers(0, 6, 60), rng.random(60) < 0.4)]
    df = spark.createDataFrame(data, "score double, pos boolean")
    wins = [1.0 if a > b else 0.5 if a == b else 0.0 for a, p in data if p for b, q in data if not q]
    assert evaluate.auc(df, F.col("pos"), "score").first()[0] == pytest.approx(sum(wins) / len(wins))


def test_class_metrics_equal_the_evaluator(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    rng = np.random.default_rng(4)
    rows = [(float(a), float(b)) for a, b in zip(rng.integers(0, 3, 50), rng.integers(0, 4, 50))]
    df = spark.createDataFrame(rows, "label double, prediction double")
    got = evaluate.multiclass_metrics(evaluate.confusion(df)).first()
    names = {"accuracy": "accuracy", "recall": "weightedRecall", "precision": "weightedPrecision", "f_measure": "f1"}
    for mine, theirs in names.items():
        assert got[mine] == pytest.approx(MulticlassClassificationEvaluator(metricName=theirs).evaluate(df))


def test_rounded_accuracy_places(spark):
    df = spark.createDataFrame([(0.26, 0.34), (0.9, 0.6)], "rating double, prediction double")
    assert evaluate.rounded_accuracy(df).first()[0] == 1.0
    assert evaluate.rounded_accuracy(df, places=1).first()[0] == 0.5


def test_report_text(spark):
    train = spark.createDataFrame([(1.0,), (3.0,)], "rating double")
    test = spark.createDataFrame([(2.0, 2.0), (4.0, 3.0)], "rating double, prediction double")
    got = evaluate.report(train, test).first()
    assert got.baseline_rmse == pytest.approx(math.sqrt(2.0))
    assert got.improvement == pytest.approx(50.0)
    assert got.report == "mean rating 2.000, baseline RMSE 1.414, model RMSE 0.707, improvement 50.00"


# ---- learners ----------------------------------------------------------------------------------


def test_linear_regression_finds_the_line(spark):
    df = spark.createDataFrame([(2.0 * x + 1.0, float(x)) for x in range(10)], "label double, x double")
    model = learners.linear_regression(assemble(df, ["x"]))
    assert model.coefficients[0] == pytest.approx(2.0) and model.intercept == pytest.approx(1.0)


def test_k_means_separates(spark):
    df = spark.createDataFrame([(float(x), float(y)) for x in (0, 1, 50, 51) for y in (0, 1)], "x double, y double")
    rows = assemble(df, ["x", "y"])
    found = learners.k_means(rows).transform(rows)
    assert found.filter("x < 10").select("cluster").distinct().count() == 1
    assert learners.silhouette(found) > 0.9


def test_cluster_step_by_hand(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0]), (2, [2.0, 0.0]), (3, [9.0, 9.0])], "id int, a array<double>")
    near = learners.assign_clusters(df, "a", [[0.0, 0.0], [10.0, 10.0]])
    assert [(r.cluster, r.cost) for r in near.orderBy("id").collect()] == [(0, 0.0), (0, 4.0), (1, 2.0)]
    moved = {(r.cluster, r.dim): (r.value, r.n) for r in learners.move_centres(near, "a").collect()}
    assert moved == {(0, 0): (1.0, 2), (0, 1): (0.0, 2), (1, 0): (9.0, 1), (1, 1): (9.0, 1)}


# ---- flows -------------------------------------------------------------------------------------

COLUMNS = "row_id bigint, userid string, itemid string, rating double, Time string, Location string, Companion string"
REQUEST = {"Time": "Weekend", "Location": "Home", "Companion": "Family"}


def rated(spark):
    """Users like either even or odd items; the weekend lifts every rating."""
    rows, at = [], 0
    for u in range(12):
        for i in range(10):
            if (u * 7 + i * 3) % 4 == 0:
                continue
            weekend = (u + 2 * i) % 3 == 0
            liked = (u % 2) == (i % 2)
            rating = 1.0 + 3.0 * liked + weekend
            time = "Weekend" if weekend else "Weekday"
            rows.append((at, f"u{u}", f"i{i}", rating, time, "Home", "Family" if i < 8 else "Alone"))
            at += 1
    return spark.createDataFrame(rows, COLUMNS)


def test_item_scores_equal_row_scores(spark):
    """The decomposed request score is the score of the whole row."""
    df = rated(spark)
    dictionary = feature_dictionary(df)
    n = dictionary.count()
    rng = np.random.default_rng(8)
    model = model_of(spark, 0.1, rng.normal(0, 0.2, n), rng.normal(0, 0.3, (n, 4)))
    mine = {r.itemid: r.rating for r in recommend.score_items(dictionary, model, "u3", REQUEST).collect()}
    rows = spark.createDataFrame([(i, "u3", f"i{i}", 0.0, *REQUEST.values()) for i in range(10)], COLUMNS)
    whole = fm.score_contextual(rows, dictionary, model, F.col("row_id"))
    long = fm.score_long(long_features(encode(rows, dictionary, F.col("row_id")), "row_id"), model)
    other = {r.row_id: r.prediction for r in long.collect()}
    for r in whole.collect():
        assert mine[r.itemid] == pytest.approx(r.prediction) == pytest.approx(other[r.row_id])
    salted = fm.score_contextual(rows, dictionary, model, F.col("row_id"), broadcast_bytes=-1)
    assert {r.itemid: r.prediction for r in salted.collect()} == pytest.approx(mine)


def test_unknown_user_and_context(spark):
    df = rated(spark)
    dictionary = feature_dictionary(df)
    model = model_of(spark, 0.5, np.zeros(dictionary.count()), np.zeros((dictionary.count(), 2)))
    seen = recommend.request_vector(dictionary, model, "nobody", {"Time": "Never"}).first()
    assert (seen.base, seen.known) == (0.5, 0)
    assert recommend.score_items(dictionary, model, "nobody", {"Time": "Never"}).count() == 10


def test_blocks_follow_memory_and_cores(spark):
    """Every block of items gets the factors of nearly every user, so there are no more blocks than needed."""
    least = max(10, spark.sparkContext.defaultParallelism)
    assert als.blocks_for(spark.range(10)) == least
    assert als.blocks_for(spark.range(28_800_000)) == least
    assert als.blocks_for(spark.range(40 * als.BLOCK_ROWS + 1)) == max(41, least)


def test_grid_works_out_its_ratings_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def rating(i):
        seen.add(1)
        return float(i % 7) / 3 - 1

    coded = spark.range(120, numPartitions=3).select(
        (F.col("id") % 12).cast("int").alias(als.USER_I), (F.col("id") % 10).cast("int").alias(als.ITEM_I), rating("id").alias("rating")
    )
    fitted = als.fit_grid(coded, {"rank": (1, 2), "regParam": (0.1,)}, nonnegative=True, iterations=1)
    assert len(fitted.validationMetrics) == 2 and fitted.bestModel.userFactors.count() == 12
    assert seen.value == 120


def test_filters_around_als(spark):
    df = rated(spark)
    coded, users, items = recommend.indexed_ratings(df, F.col("row_id"))
    model = als.fit(coded, rank=3, iterations=8, reg=0.05)
    factors = recommend.als_factors(model, users, items)
    rated_by = {(r.userid, r.itemid) for r in df.collect()}
    inside = {r.itemid for r in df.collect() if r.Time == "Weekend" and r.Companion == "Family"}
    mine = {i for u, i in rated_by if u == "u2"}
    post = [r.itemid for r in recommend.recommend_postfiltered(df, factors, "u2", REQUEST).collect()]
    assert set(post) <= inside - mine
    pre = [r.itemid for r in recommend.recommend_prefiltered(df, factors, "u2", REQUEST).collect()]
    assert set(pre) <= inside and set(post) <= set(pre)
    assert recommend.recommend_prefiltered(df, factors, "nobody", REQUEST).count() == 0
    want = model.transform(coded.filter("userid = 'u2'").select("useridI", "itemidI", "itemid"))
    got = {r.itemid: r.rating for r in factors.score(df.select("itemid").distinct(), "u2").collect()}
    for r in want.collect():
        assert got[r.itemid] == pytest.approx(r.prediction, abs=1e-5)


def test_mean_of_repeated_pairs(spark):
    df = spark.createDataFrame([(1, 2, 4.0), (1, 2, 2.0), (1, 3, 5.0)], "useridI int, itemidI int, rating double")
    assert sorted(map(tuple, als.mean_pairs(df).collect())) == [(1, 2, 3.0), (1, 3, 5.0)]


@pytest.mark.parametrize("sizes", [(1024, 16384), (2, 3)])
def test_batch_lists_equal_single_requests(spark, sizes):
    """Small chunks and blocks, so that several of both meet; tied scores go by item."""
    from sitrec.plans.batch import recommend_batch

    df = rated(spark)
    dictionary = feature_dictionary(df)
    n = dictionary.count()
    rng = np.random.default_rng(8)
    model = model_of(spark, 0.3, rng.normal(0, 0.5, n).round(1), np.zeros((n, 2)), low=-0.5, high=0.5)
    requests = spark.createDataFrame([(u, f"u{u}", *REQUEST.values()) for u in range(12)] + [(99, "nobody", "x", "y", "z")], "request_id bigint, userid string, Time string, Location string, Companion string")
    got = recommend_batch(requests, dictionary, model, 4, chunk=sizes[0], block=sizes[1]).collect()
    for request, user, context in [(3, "u3", REQUEST), (11, "u11", REQUEST), (99, "nobody", {"Time": "x"})]:
        want = recommend.recommend_by_model(dictionary, model, user, context).limit(4).collect()
        mine = sorted((r for r in got if r.request_id == request), key=lambda r: r["rank"])
        assert [r.itemid for r in mine] == [r.itemid for r in want]
        assert [r.rating for r in mine] == pytest.approx([r.rating for r in want])


def test_als_save_and_load(spark):
    coded, _, _ = recommend.indexed_ratings(rated(spark), F.col("row_id"))
    model, path = als.fit(coded, rank=2, iterations=2), new_path(spark, "als")
    als.save(model, path)
    a, b = (sorted((r.row_id, r.prediction) for r in m.transform(coded).collect()) for m in (model, als.load(path)))
    assert a == b


def test_split_items_recommendation(spark):
    df = rated(spark)
    from sitrec.operators.relational import split_items

    coded, users, items = recommend.indexed_ratings(split_items(df), F.col("row_id"))
    factors = recommend.als_factors(als.fit(coded, rank=2, iterations=4), users, items)
    best = recommend.recommend_split_items(df, factors, "u1", k=4).orderBy("rank").collect()
    assert [r["rank"] for r in best] == [1, 2, 3, 4]
    assert all(r.itemid.count("\t") == 3 for r in best)
    own = {r.itemid for r in split_items(df).filter("userid = 'u1'").collect()}
    assert not own & {r.itemid for r in best}


def test_staged_run(spark):
    path = new_path(spark, "run")
    stages.prepare(rated(spark), path)
    grid = {
        "iterations": (15,),
        "global_bias": (True,),
        "one_way": (True,),
        "factors": (2, 4),
        "reg_intercept": (0.0,),
        "reg_one_way": (0.0,),
        "reg_pairwise": (0.01,),
        "init_std": (0.1,),
    }
    results = stages.design(spark, path, grid)
    assert results.count() == 4
    model = stages.train(spark, path)
    rows = stages.run_table(spark, path, "features")
    assert search.fm_rmse(model, rows) < rows.agg(F.stddev_pop("label")).first()[0]
    # u2 likes even items
    best = stages.predict(spark, path, "u2", REQUEST).limit(4).collect()
    assert best and all(int(r.itemid[1:]) % 2 == 0 for r in best)


def test_failed_train_leaves_the_former_model_served(spark, monkeypatch):
    path = new_path(spark, "run")
    with pytest.raises(ValueError, match="prepare has not finished"):
        stages.train(spark, path, FMSettings(iterations=2))
    stages.prepare(rated(spark), path)
    with pytest.raises(ValueError, match="train has not finished"):
        stages.predict(spark, path, "u2", REQUEST)
    stages.train(spark, path, FMSettings(iterations=5))
    before = stages.predict(spark, path, "u2", REQUEST).collect()
    lines = stages.commits(spark, path).count()

    def lost(*args):
        raise RuntimeError("executor lost")

    stages.prepare(rated(spark).filter("userid <> 'u2'"), path)
    with monkeypatch.context() as patched:
        patched.setattr(stages, "fm_train_lbfgs", lost)
        with pytest.raises(RuntimeError):
            stages.train(spark, path, FMSettings(iterations=5))
        patched.setattr(FMModel, "save", lost)
        with pytest.raises(RuntimeError):
            stages.train(spark, path, FMSettings(iterations=5))
    assert stages.predict(spark, path, "u2", REQUEST).collect() == before
    assert stages.commits(spark, path).count() == lines + 1  # of the second preparation

    # the same step again trains the rows prepared last, and a third call finds its model
    model = stages.train(spark, path, FMSettings(iterations=5))
    assert stages.train(spark, path, FMSettings(iterations=5)).intercept == model.intercept
    assert stages.commits(spark, path).count() == lines + 2
    assert stages.train(spark, path, FMSettings(iterations=6)) and stages.commits(spark, path).count() == lines + 3


def test_index_of_factors_follows_frequency(spark):
    df = rated(spark)
    users = index_table(df, "userid")
    assert users.agg(F.max("idx")).first()[0] == 11
