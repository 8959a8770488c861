import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from logtide.operators import density_parts
from logtide.functions.patterns import NUMERIC_FEATURES
from logtide.functions.quantiles import exact_quantile
from logtide.operators.autoencoder import Autoencoder, layer_sizes, train_autoencoder
from logtide.operators.density import core_points, label_against_cores, label_noise
from logtide.operators.ensemble import attach_labels, ensemble_vote
from logtide.operators.iforest import average_path, fit_isolation_forest, tree_samples
from logtide.operators.registry import ModelRegistry, load_model, load_registry
from logtide.plans.anomaly import AnomalyPlan, shape_results, store_results


def noise_by_pairs(points, eps, min_samples):
    near = [[j for j, q in enumerate(points) if math.dist(p, q) <= eps] for p in points]
    core = [len(n) >= min_samples for n in near]
    return [int(not core[i] and not any(core[j] for j in near[i])) for i in range(len(points))]


@pytest.mark.parametrize(("eps", "min_samples"), [(0.5, 5), (1.0, 4), (1.5, 3), (0.3, 1)])
def test_noise_equals_brute_force(spark, eps, min_samples):
    rng = random.Random(7)
    points = []
    for i in range(400):
        if i % 3 == 0:  # a third of all points share one cell
            points.append((1, 0, rng.uniform(0, 0.2), rng.uniform(0, 0.2)))
        elif i % 3 == 1:
            points.append((rng.randint(0, 4), rng.randint(0, 2), rng.uniform(-3, 3), rng.uniform(-3, 3)))
        else:  # repeats and exact distances
            points.append((2, 1, rng.randint(0, 8) / 4, rng.randint(0, 40) * 0.5))
    table = spark.createDataFrame(
        [(i, *p) for i, p in enumerate(points)], "id int, a int, b int, x double, y double"
    )
    rows = label_noise(table, eps, min_samples, ["a", "b"], ["x", "y"]).orderBy("id").collect()
    assert [r.dbscan_label for r in rows] == noise_by_pairs(points, eps, min_samples)
    cores = core_points(table, eps, min_samples, ["a", "b"], ["x", "y"])
    stored = label_against_cores(table, cores, eps, ["a", "b"], ["x", "y"]).orderBy("id").collect()
    assert [r.dbscan_label for r in stored] == [r.dbscan_label for r in rows]


def test_missing_values_are_noise(spark):
    table = spark.createDataFrame([(1, 1.0)] * 5 + [(1, None)], "a int, x double")
    rows = label_noise(table, whole=["a"], real=["x"]).collect()
    assert sorted(r.dbscan_label for r in rows) == [0] * 5 + [1]


@pytest.mark.parametrize("limit", [200_000, 64])
def test_quantile_is_exact(spark, limit):
    table = spark.range(5000).selectExpr("if(id % 3 = 0, 17, id * 7919 % 4001) * 0.25D AS v")
    values = np.array([r.v for r in table.collect()])
    for q in (0, 0.1, 0.5, 0.905, 1):
        assert exact_quantile(table, "v", q, limit) == pytest.approx(np.percentile(values, q * 100))
    assert math.isnan(exact_quantile(table.limit(0), "v", 0.5))


@pytest.fixture(scope="module")
def features(spark):
    rows = spark.range(3000).selectExpr(
        "timestamp_micros(id * 60000000) AS window_start",
        "timestamp_micros((id + 1) * 60000000) AS window_end",
        *[f"cast(1 + pmod(xxhash64(id, {i}), 4) AS bigint) AS {n}" for i, n in enumerate(NUMERIC_FEATURES)],
    )
    odd = F.col("window_start") < F.lit("1970-01-01 01:00:00").cast("timestamp")
    changed = {
        n: F.when(odd, F.col(n) + 40).otherwise(F.col(n)).cast(
            "double" if n in ("avg_msg_length", "entropy_tokens") else "bigint"
        )
        for n in NUMERIC_FEATURES
    }
    return rows.withColumns(changed).cache()


def test_samples_ignore_partitioning(spark, features):
    def draw(table):
        return sorted(
            tuple(r)
            for r in tree_samples(table, ["window_start"], NUMERIC_FEATURES, 3000, 5, 64, 1).collect()
        )

    first = draw(features.repartition(2))
    assert first == draw(features.repartition(7, "event_count"))
    assert len(first) == 5 * 64


def test_skipping_draws_every_row_equally_often(spark):
    """Rows, trees and pairs of trees are drawn as often as independent draws would be."""
    rows, trees, size = 20_000, 40, 64
    table = spark.range(rows).selectExpr("id AS k", "cast(id AS double) AS v")
    drawn = [(r.tree, int(r.v)) for r in tree_samples(table, ["k"], ["v"], rows, trees, size, 3).collect()]
    assert len(drawn) == len(set(drawn)) == trees * size
    per_slice = np.bincount([v * 20 // rows for _, v in drawn], minlength=20)
    expected = trees * size / 20
    assert ((per_slice - expected) ** 2 / expected).sum() < 43.8  # chi square, 19 degrees, 0.1 %
    taken = {}
    for tree, v in drawn:
        taken.setdefault(v, []).append(tree)
    twice = sum(len(t) * (len(t) - 1) / 2 for t in taken.values())
    usual = trees * (trees - 1) / 2 * size * size / rows
    assert abs(twice - usual) < 5 * usual**0.5
    plan = tree_samples(table, ["k"], ["v"], rows, trees, size, 3)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.rindex("Filter (") < plan.index("Range")


def test_forest_finds_outliers(spark, features):
    forest = fit_isolation_forest(features, contamination=0.02, seed=4)
    assert forest.nodes.groupby("tree").size().max() <= 2 * 256 - 1
    assert forest.nodes["tree"].nunique() == 100
    labelled = forest.label(features)
    flagged = labelled.filter("isolation_forest_label = 1")
    assert flagged.count() == 60
    assert flagged.filter("window_start < '1970-01-01 01:00:00'").count() == 60
    assert average_path(2) == 1 and average_path(256) == pytest.approx(10.2448, abs=1e-3)


def test_forest_of_few_rows(spark, features):
    few = features.orderBy("window_start").limit(3)
    assert fit_isolation_forest(few, trees=3).label(few).count() == 3


def test_gradient_is_right():
    model = Autoencoder.initial(seed=1)
    x = np.random.default_rng(0).uniform(0, 3, (5, 8))
    share = np.array([1, 2, 1, 3, 1.0])
    gradient, loss = model.gradient(x, share)
    flat = model.parameters()
    assert flat.size == 98 and layer_sizes(8) == [8, 4, 2, 4, 8]
    for i in range(flat.size):
        moved = flat.copy()
        moved[i] += 1e-6
        slope = (model.replaced(moved).gradient(x, share)[1] - loss) / 1e-6
        assert slope == pytest.approx(gradient[i], abs=1e-4)
    with pytest.raises(ValueError, match="at least one"):
        Autoencoder.initial([])


def test_training_lowers_loss_and_ignores_partitioning(spark, features):
    one = train_autoencoder(features.repartition(1), epochs=4)
    many = train_autoencoder(features.repartition(6), epochs=4)
    assert one.losses == pytest.approx(many.losses)
    assert one.losses == sorted(one.losses, reverse=True)
    errors = [r.e for r in features.select(one.error().alias("e")).collect()]
    flagged = one.label(features).filter("autoencoder_label = 1").count()
    assert flagged == sum(e > np.percentile(errors, 90) for e in errors)


def test_votes_and_keyed_labels(spark):
    rows = [(k, k & 1, k >> 1 & 1, k >> 2) for k in range(8)]
    names = ["isolation_forest_label", "dbscan_label", "autoencoder_label"]
    table = spark.createDataFrame(rows, ["window_start", *names])
    joined = attach_labels(table.select("window_start"), *[table.select("window_start", n) for n in names])
    for row in ensemble_vote(joined).collect():
        assert row.ensemble_anomaly == int(bin(row.window_start).count("1") >= 2)


def test_plan_registry_and_results(spark, features, tmp_path):
    plan = AnomalyPlan(epochs=2).fit(features).keep_for_streams(features)
    plan.registry.save(spark, str(tmp_path / "models"))
    saved = load_registry(spark, str(tmp_path / "models"))
    for name in ("isolation_forest", "dbscan", "autoencoder"):
        label = f"{name}_label"
        before = plan.registry.predict(features, name).select("window_start", label)
        after = saved.predict(features, name).select("window_start", label)
        assert before.exceptAll(after).count() == 0
    assert saved.get("autoencoder").threshold == plan.registry.get("autoencoder").threshold
    with pytest.raises(KeyError):
        load_model(spark, str(tmp_path / "models"), "svm")
    with pytest.raises(KeyError):
        ModelRegistry().predict(features, "dbscan")
    assert ModelRegistry().get("dbscan") is None
    labelled = plan.label(features)
    assert len(shape_results(labelled).columns) == 15
    assert store_results(labelled, "stored_anomalies") == 3000
    assert spark.table("stored_anomalies").count() == 3000


@pytest.mark.parametrize(("most", "chunk"), [(60, 16_000), (10_000, 16_000), (10_000, 70)])
def test_noise_in_five_dimensions_equals_pairs(spark, monkeypatch, most, chunk):
    """Clusters, repeated rows, far points and nulls; parts and chunks of any size."""
    monkeypatch.setattr(density_parts, "CHUNK", chunk)
    rng = np.random.default_rng(4)
    middles = rng.normal(size=(4, 5)) * 3
    near = middles[rng.integers(0, 4, 250)] + rng.normal(size=(250, 5)) * 0.35
    points = np.round(np.vstack([near, rng.normal(size=(80, 5)) * 3, np.repeat(middles[:1], 30, 0)]), 3)
    expected = noise_by_pairs(points.tolist(), 0.9, 5)
    names = list("abcde")
    rows = [(i, *map(float, p)) for i, p in enumerate(points)] + [(1000, None, 0.0, 0.0, 0.0, 0.0)]
    table = spark.createDataFrame(rows, "id long, " + ", ".join(f"{n} double" for n in names))
    found = {r.id: r.dbscan_label for r in density_parts.label_noise(table, 0.9, 5, names, most=most).collect()}
    assert found.pop(1000) == 1
    assert [found[i] for i in range(len(points))] == [int(x) for x in expected]
    assert 0 < sum(found.values()) < len(points) - 100


def test_parts_copy_only_margins(spark):
    rows = [(float(i % 100), float(i // 100)) for i in range(4000)]
    table = spark.createDataFrame(rows, "a double, b double")
    vectors = density_parts._vectors(table, ["a", "b"], 0.5, 5)
    parts = density_parts.parts_of(vectors, 2, 0.5, 300)
    sizes = [r["count"] for r in parts.filter("home").groupBy("part").count().collect()]
    assert sum(sizes) == 4000 and max(sizes) <= 300
    assert parts.count() < 4400


def test_noise_of_nothing(spark):
    empty = spark.createDataFrame([], "a double, b double, c double")
    assert density_parts.label_noise(empty, 0.5, 5, ["a", "b", "c"]).count() == 0
