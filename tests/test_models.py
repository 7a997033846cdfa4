import datetime as dt

import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from checks import registry
from tarmac.operators import delay_model, features
from tests.conftest import one, rows


@pytest.fixture(scope="module")
def split_rows(spark, small):
    # all years and flights: the smallest tables hold few flights after 2000
    plain = features.model_features(registry.flights(spark, small), start=None, end=None)
    return features.with_split(features.labelled(plain)).cache()


@pytest.fixture(scope="module")
def models(split_rows):
    classifier = delay_model.fit_classifier(split_rows, delay_model.Boosting(rounds=5))
    regressor = delay_model.fit_regressor(split_rows, delay_model.Boosting(rounds=5, depth=7))
    return classifier, regressor


def test_defaults():
    assert (delay_model.CLASSIFIER.rounds, delay_model.CLASSIFIER.depth, delay_model.REGRESSOR.depth) == (300, 6, 7)
    names = features.NUMERIC_FEATURES + features.WEATHER_FEATURES + features.CATEGORICAL_FEATURES
    assert len(names) == len(set(names)) == 20


def test_labels_and_range(spark, small):
    rows_in = registry.flights(spark, small)
    some = features.model_features(rows_in, start=dt.date(1998, 1, 1), end=dt.date(1999, 1, 1))
    expected = rows_in.where("NOT IS_CANCELLED AND YEAR = 1998").count()
    assert some.count() == expected
    assert features.feature_names(some) == features.NUMERIC_FEATURES + features.CATEGORICAL_FEATURES


def test_weather_features_take_defaults(spark, small):
    from tarmac.sources.tables import add_missing_columns

    empty = add_missing_columns(registry.flights(spark, small))
    shown = features.model_features(empty, start=None, end=None).select(features.WEATHER_FEATURES).distinct()
    assert rows(shown) == [(15.0, 0.0, 0.0, 10.0, 12.0, 10000.0, 50.0, 0, 15.0, 10.0, 10000.0, 0)]


def test_labelled_clips_and_drops(spark):
    frame = spark.createDataFrame([(1, 500.0), (0, -3.0), (None, 5.0), (1, None)], "LABEL_CLASS int, LABEL_REG double")
    assert rows(features.labelled(frame)) == [(1, 300.0), (0, 0.0)]


def test_split_is_repeatable_and_stratified(split_rows):
    plain = split_rows.drop("IS_VALIDATION")
    again = features.with_split(plain.repartition(7))
    held = [sorted(rows(frame.where("IS_VALIDATION").drop("IS_VALIDATION")), key=str) for frame in (split_rows, again)]
    assert held[0] == held[1]
    for _, train, rest in rows(features.split_summary(split_rows)):
        assert train == ((train + rest) * 80 + 50) // 100


def test_split_of_equal_rows_few_rows_and_no_label(spark):
    given = [(0, 1)] * 1_000 + [(1, k) for k in range(7)] + [(None, 5)] * 3 + [(2, 9)]
    frame = spark.createDataFrame(given, "LABEL_CLASS int, N int").repartition(5)
    got = {label: (train, held) for label, train, held in rows(features.split_summary(features.with_split(frame)))}
    assert got == {0: (800, 200), 1: (6, 1), None: (2, 1), 2: (1, 0)}
    assert rows(features.with_split(frame.limit(0))) == []


def test_smallest_per_group_equals_sorting(spark):
    from tarmac.operators.keys import smallest_per_group

    frame = spark.range(5_000).select((F.col("id") % 3).cast("int").alias("g"), F.shiftrightunsigned(F.xxhash64(F.col("id") % 4_000), 4).alias("h"))
    for wanted in (1, 700, 1_600, 9_999):
        found = smallest_per_group(frame, "g", "h", {g: wanted for g in range(3)})
        for g in range(3):
            values = sorted(r.h for r in frame.where(F.col("g") == g).collect())
            if wanted > len(values):
                assert g not in found
            else:
                border = values[wanted - 1]
                assert found[g] == (border, wanted - values.index(border))


def test_best_round():
    assert delay_model.best_round([3, 2, 1, 1, 1], 2) == (3, True)
    assert delay_model.best_round([3, 2, 1, 1, 0.5], 3) == (5, False)
    assert delay_model.best_round([1, 2, 3], 30) == (1, False)


def test_a_fit_to_noise_stops_early(spark):
    """Labels that have nothing to do with the features: more rounds only fit the training rows."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    noise = spark.range(600).select(F.rand(1).alias("x"), F.rand(2).alias("y"), F.randn(3).alias("label"), (F.col("id") % 3 == 0).alias("held"))
    ready = VectorAssembler(inputCols=["x", "y"], outputCol="features").transform(noise).cache()
    settings = delay_model.Boosting(rounds=40, depth=4, rate=0.3, flat_rounds=5)
    model = GBTRegressor(featuresCol="features", labelCol="label", maxDepth=4, stepSize=0.3, seed=1, maxIter=40)
    fitted = delay_model.fit_stopping(model, ready.where("NOT held"), ready.where("held"), settings)
    losses = model.fit(ready.where("NOT held")).evaluateEachIteration(ready.where("held"), "squared")
    best = losses.index(min(losses[: fitted.getNumTrees + 5])) + 1
    assert fitted.getNumTrees == best < 10


def test_class_weight_without_positives(spark):
    frame = spark.createDataFrame([(0,), (0,)], "LABEL_CLASS int")
    assert one(features.class_weight(frame)) == (2, 0, 2.0)


def test_out_of_fold_means_against_brute_force(spark):
    given = [("AA", "ATL", "LAX", fold % 5, (fold * 7) % 3 % 2) for fold in range(60)]
    given += [("DL", "ATL", "SEA", fold % 5, fold % 2) for fold in range(30)] + [("ZZ", "BOS", "SEA", 1, 1)]
    frame = spark.createDataFrame(given, "OP_CARRIER string, ORIGIN string, DEST string, FOLD int, LABEL_CLASS int")
    got = {row[:3]: row[3] for row in rows(features.out_of_fold_means(frame, "LABEL_CLASS"))}
    for at, feature in enumerate(features.CATEGORICAL_FEATURES):
        for value, fold in {(row[at], row[3]) for row in given}:
            rest = [row[4] for row in given if row[3] != fold]
            own = [row[4] for row in given if row[3] != fold and row[at] == value]
            level = sum(rest) / len(rest)
            if not own:
                expected = level
            else:
                mean = sum(own) / len(own)
                spread = level - level * level
                within = mean - mean * mean
                trust = spread * len(own) / (spread * len(own) + within)
                expected = trust * mean + (1 - trust) * level
            assert got[(feature, value, fold)] == pytest.approx(expected)


def test_encoding_join_with_and_without_broadcast(split_rows):
    folded = features.with_fold(split_rows.where("NOT IS_VALIDATION"))
    small = features.with_out_of_fold_means(folded, "LABEL_CLASS", "_mean")
    large = features.with_out_of_fold_means(folded, "LABEL_CLASS", "_mean", limit=0)
    sums = [F.round(F.sum(f"{name}_mean"), 6) for name in features.CATEGORICAL_FEATURES]
    assert one(small.agg(F.count(F.lit(1)), *sums)) == one(large.agg(F.count(F.lit(1)), *sums))
    assert small.count() == folded.count()


def test_feature_rows(spark):
    given = spark.createDataFrame([(8, 2, 5, 500.0, 90.0, None, "AA", "ATL", "LAX")],
        "DEP_HOUR int, DEP_DOW int, DEP_MONTH int, FLIGHT_DISTANCE double, SCHED_ELAPSED_MIN double,"
        " ORIGIN_TEMP_C double, OP_CARRIER string, ORIGIN string, DEST string")  # fmt: skip
    names = ["DEST", "ORIGIN_TEMP_C", "ORIGIN_VIS_M", "DEP_HOUR", "SOMETHING_NEW"]
    built = features.feature_rows(given, names)
    assert built.columns == names
    assert one(built) == ("LAX", 15.0, 10000.0, 8, 0.0)


def test_scores_and_metrics(split_rows, models):
    classifier, regressor = models
    scored = delay_model.score(split_rows, classifier, regressor)
    assert scored.count() == split_rows.count()
    p, q, minutes, expected, level = (F.col(n) for n in (
        "DELAY_PROBABILITY", "ON_TIME_PROBABILITY", "PREDICTED_DELAY_MIN", "EXPECTED_DELAY_MIN", "RISK_LEVEL"))
    wrong = scored.where(~p.between(0, 1) | (F.abs(p + q - 1) > 0.0002) | ~minutes.between(0, 300) | (expected > minutes + 0.1) | level.isNull())
    assert wrong.count() == 0
    metrics = delay_model.evaluate(split_rows, classifier, regressor).collect()[0].asDict()
    assert metrics["VALIDATION_ROWS"] == split_rows.where("IS_VALIDATION").count()
    assert 0 <= metrics["ACCURACY"] <= 1 and 0 < metrics["AUC_ROC"] <= 1 and metrics["RMSE"] >= metrics["MAE"] > 0


def test_tree_rows_score_as_the_model_does(spark, split_rows, models):
    from tarmac.operators import tree_rows

    classifier, regressor = models
    both = regressor.transform(classifier.transform(split_rows))
    delay, minutes = (tree_rows.margin_text(tree_rows.tree_nodes(spark, model)) for model in models)
    off = both.select(
        F.abs(1 / (1 + F.exp(-2 * F.expr(delay))) - vector_to_array("clf_probability")[1]).alias("p"),
        F.abs(F.expr(minutes) - F.col("reg_prediction")).alias("m"),
    )
    assert all(x < 1e-9 for x in one(off.agg(F.max("p"), F.max("m"))))
    table = tree_rows.node_table(spark, tree_rows.tree_nodes(spark, classifier))
    assert table.where("FEATURE IS NULL").count() == table.where("FEATURE IS NOT NULL").count() + delay_model.rounds_of(classifier)


def test_unknown_carrier_is_scored(split_rows, models):
    unseen = split_rows.limit(3).withColumn("OP_CARRIER", F.lit("??"))
    assert delay_model.score(unseen, *models).where("DELAY_PROBABILITY IS NOT NULL").count() == 3


def test_artifacts(spark, split_rows, models, tmp_path):
    path = str(tmp_path / "model")
    metrics = delay_model.evaluate(split_rows, *models)
    delay_model.save_artifacts(split_rows, *models, metrics, path)
    again = delay_model.load_models(path)
    few = split_rows.where("IS_VALIDATION").orderBy(*split_rows.columns).limit(50)
    before, after = (sorted(rows(delay_model.score(few, *pair))) for pair in (models, again))
    assert before == after
    names = spark.read.json(f"{path}/feature_names").orderBy("POSITION")
    assert [r[0] for r in rows(names.select("FEATURE"))] == features.feature_names(split_rows)
    origins = split_rows.select("ORIGIN").distinct().count()
    assert spark.read.json(f"{path}/category_values").where("FEATURE = 'ORIGIN'").count() == origins
    noted = {"TRAINED_AT", "SAMPLE_SHARE", "TRAINING_ROWS", "USE_WEATHER", "CLASSIFIER_ROUNDS", "REGRESSOR_ROUNDS"}
    assert noted <= set(spark.read.json(f"{path}/metrics").columns)


@pytest.mark.parametrize("kind", ["classifier", "regressor"])
def test_a_stopped_fit_is_the_start_of_a_longer_one(spark, kind):
    rows = spark.range(600).selectExpr("double(id % 2) AS y", "double(id * 7919 % 101) AS a", "double((id * 31 + id % 2 * 9) % 17) AS b")
    rows = VectorAssembler(inputCols=["a", "b"], outputCol="x").transform(rows).cache()
    model = (GBTClassifier if kind == "classifier" else GBTRegressor)(
        featuresCol="x", labelCol="y", predictionCol="said", maxIter=6, maxDepth=3, subsamplingRate=0.8, featureSubsetStrategy="0.8", seed=7
    )
    part, short = delay_model.first_rounds(model.fit(rows), 4), model.copy({model.maxIter: 4}).fit(rows)
    assert part.getNumTrees == 4 and part.toDebugString.split("\n", 1)[1] == short.toDebugString.split("\n", 1)[1]
    assert part.transform(rows).select("said").collect() == short.transform(rows).select("said").collect()
    fits = []

    class Counted(type(model)):
        def fit(self, dataset, params=None):
            fits.append(self.getMaxIter())
            return super().fit(dataset, params)

    counted = Counted(featuresCol="x", labelCol="y", predictionCol="said", maxDepth=3, seed=7)
    settings = delay_model.Boosting(rounds=5, flat_rounds=2)
    delay_model.fit_stopping(counted, rows, rows.where("a < 50"), settings)
    assert fits == [5]  # no second fit up to the best round


def test_a_falling_loss_is_fitted_twice_at_most(spark):
    """A few rounds to see whether the stop rule holds, then all of them: no fit in between is thrown away."""
    line = spark.range(400).selectExpr("double(id % 100) AS x", "double(id % 100) AS y", "id % 4 = 0 AS held")
    line = VectorAssembler(inputCols=["x"], outputCol="features").transform(line).cache()
    fits = []

    class Counted(GBTRegressor):
        def fit(self, dataset, params=None):
            fits.append(self.getMaxIter())
            return super().fit(dataset, params)

    counted = Counted(featuresCol="features", labelCol="y", maxDepth=3, stepSize=0.05, seed=7)
    fitted = delay_model.fit_stopping(
        counted, line.where("NOT held"), line.where("held"), delay_model.Boosting(rounds=24, rate=0.05, flat_rounds=2)
    )
    assert fits == [8, 24] and fitted.getNumTrees == 24


def test_training_rows_are_on_all_cores(spark, split_rows, monkeypatch):
    """The rows of one task are read thousands of times by one core while the others wait."""
    seen = []

    def stop(model, train, held_out, settings):
        seen.append((train.rdd.getNumPartitions(), train.count(), held_out.count()))
        raise StopIteration

    monkeypatch.setattr(delay_model, "fit_stopping", stop)
    narrow, cores = split_rows.coalesce(1), spark.sparkContext.defaultParallelism
    held = narrow.where("IS_VALIDATION").count()
    for fit, rows_per_task in ((delay_model.fit_classifier, 10**6), (delay_model.fit_regressor, 100)):
        monkeypatch.setattr(delay_model, "ROWS_PER_TASK", rows_per_task)
        with pytest.raises(StopIteration):
            fit(narrow, delay_model.Boosting(rounds=1))
        parts, train, validation = seen.pop()
        assert parts == max(cores, -(-train // rows_per_task)) and train + validation == narrow.count() and validation == held


def test_both_models_at_once_are_those_fitted_alone(split_rows, models):
    both = delay_model.fit_both(split_rows, delay_model.Boosting(rounds=5), delay_model.Boosting(rounds=5, depth=7))
    for alone, together in zip(models, both):
        assert type(alone.stages[-1]) is type(together.stages[-1])
        assert delay_model.rounds_of(alone) == delay_model.rounds_of(together)
    assert one(delay_model.evaluate(split_rows, *both)) == one(delay_model.evaluate(split_rows, *models))
