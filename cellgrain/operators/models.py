"""Classification baselines on MLlib: balanced weights, cross-validation, ensembles, leaderboards."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression, MultilayerPerceptronClassifier, OneVsRest, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, StringIndexer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cellgrain.sources import layers
from cellgrain.operators import metrics, splits


def balanced(df: DataFrame, label: str) -> DataFrame:
    """Adds features (a vector) and weight = n / (classes * rows of the class)."""
    n = df.groupBy(label).agg(F.count("*").alias("_c"))
    total = n.agg(F.sum("_c").alias("_n"), F.count("*").alias("_k"))
    w = n.crossJoin(total).select(label, (F.col("_n") / (F.col("_k") * F.col("_c"))).alias("weight"))  # a row a class
    return df.join(F.broadcast(w), label).withColumn("features_raw", array_to_vector("vec"))


def pipeline(kind: str, label: str, seed: int = 42, **options) -> Pipeline:
    """Index labels, scale, classify. ``kind``: lr, rf, svm (linear, one against the rest) or mlp (needs ``layers``)."""
    common = {"featuresCol": "features", "labelCol": "label_index"}
    if kind == "lr":
        model = LogisticRegression(**common, weightCol="weight", maxIter=options.pop("maxIter", 1000), family="multinomial", **options)
    elif kind == "rf":
        model = RandomForestClassifier(**common, weightCol="weight", numTrees=options.pop("numTrees", 100), maxDepth=options.pop("maxDepth", 15), seed=seed, **options)
    elif kind == "svm":
        model = OneVsRest(classifier=LinearSVC(maxIter=options.pop("maxIter", 50), **options), **common, weightCol="weight", parallelism=4)
    elif kind == "mlp":
        model = MultilayerPerceptronClassifier(**common, seed=seed, **options)
    else:
        raise ValueError(f"kind {kind!r} is none of 'lr', 'rf', 'svm', 'mlp'")
    index = StringIndexer(inputCol=label, outputCol="label_index", stringOrderType="alphabetAsc", handleInvalid="keep")
    return Pipeline(stages=[index, StandardScaler(inputCol="features_raw", outputCol="features", withMean=True), model])


def fit(df: DataFrame, kind: str, label: str = "label", **options) -> PipelineModel:
    return pipeline(kind, label, **options).fit(balanced(df, label))


#: Rows, about, of a part that a fit reads again and again; and nodes of trees that the driver may hold at once.
PART_ROWS, NODES = 250_000, 1 << 17


def dealt_out(df: DataFrame, **options) -> DataFrame:
    """splits.stratified(), kept, in a part a core unless parts would be large: every reading of a fit sends a message a part."""
    dealt = layers.checkpoint(splits.stratified(df, **options))
    return dealt.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-dealt.count() // PART_ROWS)))


def grove(train: DataFrame, label: str, fits: int = 1, seed: int = 42, numTrees: int = 100, maxDepth: int = 15, **options) -> Iterator[tuple[PipelineModel, int]]:
    """A forest as models of some of its trees, one after the other, and their numbers of trees: the driver holds NODES nodes at
    most over ``fits`` forests at the same time, but two trees of each at least. A model's votes add up to the forest's. A forest that is small enough is one model."""
    rows = balanced(train, label)
    index, scale, _ = pipeline("rf", label).getStages()
    ready = Pipeline(stages=[index, scale]).fit(rows)
    kept = layers.checkpoint(ready.transform(rows).select("features", "label_index", "weight"))
    each, done = min(2 ** (maxDepth + 1), 2 * max(kept.count(), 1)), 0  # a leaf has a row
    while done < numTrees:
        n = min(numTrees - done, max(2, int(NODES // (fits * each))))
        if numTrees - done - n == 1:  # one tree alone would take all features at each node
            n = n + 1 if n < 3 else n - 1
        some = RandomForestClassifier(featuresCol="features", labelCol="label_index", weightCol="weight", numTrees=n, maxDepth=maxDepth, seed=seed + done, **options).fit(kept)
        each, done = max(1.0, 1.25 * some.totalNumNodes / n), done + n
        yield PipelineModel(stages=[*ready.stages, some]), n


def forest_predict(train: DataFrame, df: DataFrame, label: str = "label", out: str = "predicted", fits: int = 1, **options) -> DataFrame:
    """As predict() of a forest fitted on ``train``: the votes of its models are summed by row."""
    rows, votes, names = layers.stored(df.withColumn("_row", F.monotonically_increasing_id())), [], []
    for model, _ in grove(train, label, fits, **options):
        scored = model.transform(rows.withColumn("features_raw", array_to_vector("vec"))).select("_row", F.lit(len(votes)).alias("_at"), vector_to_array("rawPrediction").alias("_votes"))
        votes.append(layers.stored(scored))
        names = model.stages[0].labels
    ordered = F.array_sort(F.collect_list(F.struct("_at", "_votes")))  # so that a sum doesn't depend on the order of tasks
    total = F.aggregate(F.slice("_o", 2, len(votes)), F.col("_o")[0]["_votes"], lambda a, x: F.zip_with(a, x["_votes"], lambda u, v: u + v))
    summed = reduce(DataFrame.unionByName, votes).groupBy("_row").agg(ordered.alias("_o")).select("_row", total.alias("_v"))
    whole = F.aggregate("_v", F.lit(0.0), lambda a, x: a + x)
    chosen = F.get(F.array(*(F.lit(x) for x in names)), (F.array_position("_v", F.array_max("_v")) - 1).cast("int"))
    found = rows.join(summed, "_row")
    return found.select(*df.columns, chosen.alias(out), F.when(whole > 0, F.transform("_v", lambda x: x / whole)).otherwise(F.col("_v")).alias("class_probability"))


def predict(model: PipelineModel, df: DataFrame, out: str = "predicted") -> DataFrame:
    """Adds the predicted label as a text, and its class probabilities where the model has them."""
    labels = F.array(*(F.lit(x) for x in model.stages[0].labels))
    x = model.transform(df.withColumn("features_raw", array_to_vector("vec")))
    probability = [vector_to_array("probability").alias("class_probability")] if "probability" in x.columns else []
    return x.select(*df.columns, F.get(labels, F.col("prediction").cast("int")).alias(out), *probability)


class CalibratedMargins:
    """A margin model whose class probabilities come from margins of rows that it hasn't seen: each of ``folds`` parts is
    scored by a model of the others, and a multinomial logistic regression learns classes from these margins. Labels
    are those of the model of all rows."""

    def __init__(self, df: DataFrame, label: str = "label", key: str = "cell_id", folds: int = 3, ridge: float = 1e-3, **options):
        dealt = dealt_out(df, label=label, key=key, parts=folds)
        parts = range(folds)
        with ThreadPool(folds + 1) as pool:  # the fits are independent jobs
            *held, self.model = pool.map(lambda i: fit(dealt.where(F.col("fold") != i).drop("fold") if i < folds else df, "svm", label, **options), [*parts, folds])
        self.labels = self.model.stages[0].labels
        seen = [self.margins(m, dealt.where(F.col("fold") == i).drop("fold")) for i, m in zip(parts, held, strict=True) if m.stages[0].labels == self.labels]
        if not seen:
            raise ValueError("a class has too few rows to hold some out")
        rows = self.model.stages[0].transform(layers.checkpoint(reduce(DataFrame.unionByName, seen)))
        learner = LogisticRegression(featuresCol="_margins", labelCol="label_index", family="multinomial", regParam=ridge, predictionCol="_p", rawPredictionCol="_r", probabilityCol="_probability")
        self.calibration = learner.fit(rows)

    def margins(self, model: PipelineModel, df: DataFrame) -> DataFrame:
        x = model.transform(df.withColumn("features_raw", array_to_vector("vec")))
        return x.select(*df.columns, F.col("rawPrediction").alias("_margins"), "prediction")

    def predict(self, df: DataFrame, out: str = "predicted") -> DataFrame:
        names = F.array(*(F.lit(x) for x in self.labels))
        x = self.calibration.transform(self.margins(self.model, df))
        probability = F.slice(vector_to_array("_probability"), 1, len(self.labels))
        return x.select(*df.columns, F.get(names, F.col("prediction").cast("int")).alias(out), probability.alias("class_probability"))


def hard_vote(lr: Column, rf: Column, svm: Column) -> Column:
    """Majority of three; without one the first voter's."""
    return F.when(rf == svm, rf).otherwise(lr)


def soft_vote(*probabilities: Column) -> Column:
    """Mean of class probabilities."""
    total = reduce(lambda a, b: F.zip_with(a, b, lambda x, y: x + y), probabilities)
    return F.transform(total, lambda x: x / len(probabilities))


def importances(model: PipelineModel) -> DataFrame:
    """feature (its place in the vector) and importance of a fitted forest: one row a feature."""
    rows = [(i, float(x)) for i, x in enumerate(model.stages[-1].featureImportances.toArray())]
    return SparkSession.active().createDataFrame(rows, "feature int, importance double")


def forest_importances(df: DataFrame, label: str = "label", **options) -> DataFrame:
    """importances() of a forest, as the mean over its trees."""
    total, trees = 0.0, 0
    for model, n in grove(df, label, **options):
        total, trees = total + n * model.stages[-1].featureImportances.toArray(), trees + n
    return SparkSession.active().createDataFrame([(i, float(x / trees)) for i, x in enumerate(total)], "feature int, importance double")


def ensemble(train: DataFrame, test: DataFrame, label: str = "label", key: str = "cell_id", options: dict | None = None, fits: int = 1) -> DataFrame:
    """``test`` with lr, rf, svm (labels by the three models), predicted (their majority) and soft (the label of the
    largest mean probability of the three). Keys are unique. ``fits``: forests that are fitted at the same time."""
    out, labels = test, []
    for kind in ("lr", "rf", "svm"):
        given = dict((options or {}).get(kind, {}))
        if kind == "svm":
            model = CalibratedMargins(train, label, key, **given)
            labels, scored = model.labels, model.predict(test.select(key, label, "vec"), kind)
        elif kind == "rf":
            scored = forest_predict(train, test.select(key, label, "vec"), label, kind, fits, **given)
        else:
            model = fit(train, kind, label, **given)
            labels, scored = model.stages[0].labels, predict(model, test.select(key, label, "vec"), kind)
        # The indexer keeps a class for unseen labels, which isn't one of them.
        out = out.join(scored.select(key, kind, F.slice("class_probability", 1, len(labels)).alias(f"_{kind}")), key)
    mean = soft_vote(F.col("_lr"), F.col("_rf"), F.col("_svm"))
    soft = F.get(F.array(*(F.lit(x) for x in labels)), (F.array_position(mean, F.array_max(mean)) - 1).cast("int"))
    return out.withColumns({"predicted": hard_vote(F.col("lr"), F.col("rf"), F.col("svm")), "soft": soft}).drop("_lr", "_rf", "_svm")


def held_out(df: DataFrame, kind: str, label: str = "label", key: str = "cell_id", **options) -> DataFrame:
    """Predictions for a stratified fifth of the rows by a model (or the ``ensemble``) of the other rows."""
    dealt = dealt_out(df, label=label, key=key)  # every fit reads it many times
    train, test = dealt.where("not is_test").drop("is_test"), dealt.where("is_test").drop("is_test")
    if kind == "svm":
        return CalibratedMargins(train, label, key, **options).predict(test)
    if kind == "rf":
        return forest_predict(train, test, label, **options)
    return ensemble(train, test, label, key, options) if kind == "ensemble" else predict(fit(train, kind, label, **options), test)


def cross_validate(df: DataFrame, kind: str, label: str = "label", key: str = "cell_id", folds: int = 5, seed: int = 42, **options) -> DataFrame:
    """model, fold, part, accuracy, balanced_accuracy, for lr, rf, svm or the ensemble (its test rows only). The scaler is fitted
    on the training rows of each fold only."""
    dealt = dealt_out(df, label=label, key=key, parts=folds, seed=seed)

    def one(i: int) -> list[DataFrame]:
        train, test = dealt.where(F.col("fold") != i).drop("fold"), dealt.where(F.col("fold") == i).drop("fold")
        if kind == "ensemble":
            scored = [("test", ensemble(train, test, label, key, options, fits))]
        elif kind == "rf":
            every = layers.stored(forest_predict(train, dealt, label, fits=fits, **options))
            scored = [("train", every.where(F.col("fold") != i)), ("test", every.where(F.col("fold") == i))]
        else:
            model = fit(train, kind, label, **dict(options))
            scored = [("train", predict(model, train)), ("test", predict(model, test))]
        return [metrics.report(x.withColumn("_y", F.col(label).cast("string")), "_y", "predicted").select(F.lit(kind).alias("model"), F.lit(i).alias("fold"), F.lit(part).alias("part"), "accuracy", "balanced_accuracy") for part, x in scored]

    fits = folds  # the folds' jobs share the cluster, if the driver has room for their trees
    if kind in ("rf", "ensemble"):
        depth = (options if kind == "rf" else options.get("rf", {})).get("maxDepth", 15)
        fits = max(1, min(folds, NODES // (2 * min(2 ** (depth + 1), 2 * max(dealt.count(), 1)))))
    with ThreadPool(fits) as pool:
        return reduce(DataFrame.unionByName, [r for part in pool.map(one, range(folds)) for r in part])


def modeling_stage(df: DataFrame, kind: str, label: str = "label", group: str | None = None, key: str = "cell_id", **options) -> DataFrame:
    """key, predicted: test rows' predictions, blank for training rows. Split by groups where given, else 80 to 20 in each label."""
    dealt = splits.patient_split(df, group) if group else splits.stratified(df, label, key)
    model = fit(dealt.where("not is_test").drop("is_test"), kind, label, **options)
    test = predict(model, dealt.where("is_test").drop("is_test")).select(key, "predicted")
    return df.select(key).join(test, key, "left").select(key, F.coalesce("predicted", F.lit("")).alias("predicted"))


def transfer_score(model: PipelineModel, query: DataFrame, label: str = "label") -> DataFrame:
    """Share of rows whose predicted text equals the label's."""
    return predict(model, query).agg(F.avg((F.col("predicted") == F.col(label).cast("string")).cast("double")).alias("transfer_accuracy"))


def fused_classify(df: DataFrame, label: str = "label", kind: str = "mlp", key: str = "cell_id", **options) -> DataFrame:
    """Predictions on fused vectors of held-out rows; the perceptron's hidden layers halve from the input's size."""
    if kind == "mlp" and "layers" not in options:
        dim = df.select(F.size("vec").alias("n")).head()["n"]
        hidden = max(64, dim // 2)
        # One output more than labels: the indexer keeps one for unseen labels.
        options["layers"] = [dim, hidden, hidden // 2, df.select(label).distinct().count() + 1]
    return held_out(df, kind, label, key, **options)


def benchmark(df: DataFrame, kinds: tuple[str, ...] = ("lr", "rf", "svm", "ensemble"), label: str = "label", key: str = "cell_id", options: dict | None = None) -> DataFrame:
    """model, metric, value on a fifth of the rows, best first."""
    options, rows, scores = options or {}, [], {}
    if "ensemble" in kinds:  # its three models are fitted once
        all_of = held_out(df, "ensemble", label, key, **options)
        scores = {k: all_of.withColumn("predicted", F.col(c)) for k, c in (("lr", "lr"), ("rf", "rf"), ("svm", "svm"), ("ensemble", "predicted"))}
    for kind in kinds:
        scored = scores[kind] if kind in scores else held_out(df, kind, label, key, **dict(options.get(kind, {})))
        scored = scored.withColumn("_y", F.col(label).cast("string"))
        for name, f in (("ari", metrics.ari), ("nmi", metrics.nmi)):
            rows.append(f(scored, "_y", "predicted").select(F.lit(kind).alias("model"), F.lit(name).alias("metric"), F.col(name).alias("value")))
    return reduce(DataFrame.unionByName, rows).orderBy(F.desc("value"), "model", "metric")
