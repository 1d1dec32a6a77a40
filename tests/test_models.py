import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from penmark.functions import text as tx
from penmark.operators import classify, evaluation, model_tables, projection, tfidf
from penmark.plans import catalog, stages
from penmark.sources import corpus
from tests.conftest import plan_of

SMALL = (classify.LOGISTIC_REGRESSION, classify.LINEAR_SVM)


@pytest.fixture(scope="module")
def fitted(spark, sf):
    return catalog.Stored.get(spark, sf)


def test_vectors_hold_vocabulary_and_style(fitted):
    terms = len(fitted.features.stages[0].vocabulary)
    train = stages.split_of(fitted.featured, "train")
    assert terms == min(tfidf.VOCAB_SIZE, tfidf.term_statistics(train).where(f"df >= {tfidf.MIN_DF}").count())
    assert fitted.vectors.first().features.size == terms + 5


def test_only_training_rows_shape_the_features(spark, fitted):
    train = stages.split_of(fitted.featured, "train")
    on_train = classify.fit_features(train, 50, 5)
    on_all = classify.fit_features(fitted.featured, 50, 5)
    on_counts = on_train.stages[0].transform(train)
    expected = tfidf.idf_estimator().fit(on_counts).idf
    assert list(on_train.stages[1].getScalingVec()) == pytest.approx(list(expected), abs=1e-12)
    assert list(on_all.stages[1].getScalingVec()) != list(on_train.stages[1].getScalingVec())
    assert on_train.stages[0].vocabulary == fitted.features.stages[0].vocabulary[:50]


def test_fit_scope_is_checked(fitted):
    with pytest.raises(ValueError):
        stages.build_vectors(fitted.featured, fitted.ws, fit_scope="test")


def test_versions_of_one_abstract_share_a_split(fitted):
    assert fitted.featured.groupBy("doc_id").agg(F.count_distinct("split").alias("n")).where("n > 1").count() == 0


def test_saved_models_score_alike(spark, fitted):
    models = fitted.models(*SMALL)
    loaded = stages.load_models(fitted.ws, SMALL)
    before = stages.predictions(fitted.vectors, models, "test")
    after = stages.predictions(fitted.vectors, loaded, "test")
    assert before.count() > 0 and before.exceptAll(after).count() == 0


def test_vectors_and_raw_rows_score_alike(spark, fitted):
    models = fitted.models(*SMALL)
    keep = (*stages.row_key(fitted.vectors), "label_index")
    from_vectors = stages.predictions(fitted.vectors, models, "test")
    from_rows = classify.score_each(stages.split_of(fitted.featured, "test"), models, *keep)
    columns = [*keep, "model", "prediction"]
    assert from_vectors.select(columns).exceptAll(from_rows.select(columns)).count() == 0


def test_training_separates_a_marked_corpus(spark, tmp_path):
    words = ["قمر", "شمس", "بحر", "جبل", "نهر", "ورد"]
    rows = [
        (i, "from_title", *[f"{words[(i * k) % 6]} {words[(i + k) % 6]} {'كتبت بنفسي' if k == 1 else 'تهدف الدراسة'}" for k in range(1, 6)])
        for i in range(200)
    ]
    wide = spark.createDataFrame(rows, ["doc_id", "generation_method", *corpus.TEXT_COLUMNS])
    ws = stages.Workspace(str(tmp_path))
    table = stages.build_features(stages.build_corpus(wide, ws), ws)
    vectors, features = stages.build_vectors(table, ws, vocab_size=40)
    models = stages.train_models(vectors, features, ws)
    report = stages.report_comparison(stages.predictions(vectors, models, "test"), ws).collect()
    assert {r.Model: r.Accuracy for r in report} == {m: 1.0 for m in classify.CLASSIFIER_SETTINGS}
    assert spark.read.csv(ws.report("model_comparison_results"), header=True).count() == 3


def test_class_weights_balance(spark, fitted, tmp_path):
    weighted = classify.with_class_weight(stages.split_of(fitted.vectors, "train"))
    totals = [r[1] for r in weighted.groupBy("label_index").agg(F.sum("class_weight")).collect()]
    assert totals[0] == pytest.approx(totals[1])
    balanced = stages.train_models(fitted.vectors, fitted.features, stages.Workspace(str(tmp_path)), (classify.LOGISTIC_REGRESSION,), balanced=True)
    plain = fitted.models(classify.LOGISTIC_REGRESSION)

    def human_recall(models):
        cells = evaluation.confusion_cells(stages.predictions(fitted.vectors, models, "train"))
        return evaluation.class_recall(cells).first().human_recall

    assert human_recall(balanced) > human_recall(plain)


def leading(x, k=2):
    values, vectors = np.linalg.eigh(np.cov(x.T))
    vectors = vectors[:, ::-1][:, :k]
    return values[::-1][:k], vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), range(k)])


def test_components_equal_numpy_on_the_embeddings(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select(F.col("embedding").cast("array<double>").alias("a"), "label")
    x = np.array([r.a for r in rows.collect()])
    df = rows.select(array_to_vector("a").alias("features"), F.lit(0).alias("label_index"))
    got = projection.fit_components(df)
    variances, vectors = leading(x)
    assert got.variances == pytest.approx(variances, rel=1e-6)
    assert got.vectors == pytest.approx(vectors, abs=1e-6)
    points = np.array([tuple(r)[:2] for r in projection.project(df, got).select("PC1", "PC2").collect()])
    assert points[np.lexsort(points.T)] == pytest.approx((x @ vectors)[np.lexsort((x @ vectors).T)], abs=1e-5)


def test_components_of_wide_sparse_and_dense_vectors(spark):
    rng = np.random.default_rng(2)
    x = np.where(rng.random((300, 700)) < 0.05, rng.exponential(size=(300, 700)), 0.0)
    x[:, 3] += rng.normal(size=300) * 5
    x[:, 650] += rng.normal(size=300) * 4 + 2
    rows = [(Vectors.sparse(700, np.flatnonzero(r).tolist(), r[r != 0].tolist()) if i % 2 else Vectors.dense(r), 1) for i, r in enumerate(x)]
    df = spark.createDataFrame([(v, y) for v, y in rows] + [(None, 1)], StructType([StructField("features", VectorUDT()), StructField("label_index", IntegerType())]))
    for layout in (df, df.repartition(5)):
        got = projection.fit_components(layout)
        assert got.vectors == pytest.approx(leading(x)[1], abs=1e-6)
    same = projection.fit_components(spark.createDataFrame([(Vectors.dense([1.0, 2.0]),)] * 3, ["features"]))
    assert same.variances == pytest.approx([0, 0]) and np.isfinite(same.vectors).all()


def test_boundary_and_margins(spark):
    points = spark.createDataFrame(
        [(float(x), float(x + s * d), int(s > 0)) for x in range(30) for s in (-1, 1) for d in (2, 3, 4)],
        "PC1 double, PC2 double, label_index int",
    )
    model = projection.fit_boundary(points)
    line = projection.boundary_line(points, model).orderBy("point").collect()
    assert len(line) == projection.LINE_POINTS
    assert (line[0].x, line[-1].x) == (0.0, pytest.approx(29.0))
    w, b = model.coefficients, model.intercept
    for p in line:
        assert w[0] * p.x + w[1] * p.y + b == pytest.approx(0, abs=1e-9)
        assert w[0] * p.x + w[1] * p.y_upper + b == pytest.approx(1, abs=1e-9)
        assert w[0] * p.x + w[1] * p.y_lower + b == pytest.approx(-1, abs=1e-9)
    middle = line[len(line) // 2]
    assert abs(middle.y - middle.x) < 1


def test_plot_points_are_trimmed_and_capped(spark):
    rows = spark.range(3000).select(
        F.col("id").alias("vec_id"), F.col("id").cast("double").alias("PC1"), (-F.col("id")).cast("double").alias("PC2")
    )
    points = projection.plot_points(rows, "vec_id")
    assert points.count() == projection.SAMPLE_ROWS
    low, high = points.agg(F.min("PC1"), F.max("PC1")).first()
    assert low >= 29.99 and high <= 2969.01


# -- models as tables ------------------------------------------------------------


def differing(fitted, model, name):
    """Rows that a model as tables scores otherwise than the fitted one, and whether it tells the classes apart."""
    key = stages.row_key(fitted.vectors)
    own = model_tables.margins(fitted.vectors, model, fitted.ws.model(name), *key)
    scored = classify.score_all(fitted.vectors, fitted.models(name), *key, "split", "label_index")
    rows = model_tables.agreement(scored, own, *key).collect()
    return sum(r.n_differ for r in rows), {r.tells_apart for r in rows}


@pytest.mark.parametrize("name", SMALL)
def test_wrong_weights_are_noticed(fitted, name):
    model = fitted.models(name)[name]
    assert differing(fitted, model, name) == (0, {True})
    last = model.stages[-1]
    turned = Vectors.dense([-w for w in last.coefficients.toArray()])

    class Turned(type(last)):
        coefficients, intercept = turned, -last.intercept

        def __init__(self):
            pass

        def getThreshold(self):
            return last.getThreshold()

    n_differ, apart = differing(fitted, type("Model", (), {"stages": [Turned()]}), name)
    assert n_differ > 0 and apart == {False}


def test_wrong_rules_are_noticed(spark, fitted):
    name = classify.RANDOM_FOREST
    forest, key = fitted.models(name)[name].stages[-1], stages.row_key(fitted.vectors)
    nodes = model_tables.node_table(spark, fitted.ws.model(name), forest)
    assert nodes.count() == sum(t.numNodes for t in forest.trees)
    depth = max(t.depth for t in forest.trees)
    own = {tuple(r)[: len(key)]: r.margin for r in model_tables.forest_margins(fitted.vectors, nodes, forest.getNumTrees, depth, *key).collect()}
    votes = forest.transform(fitted.vectors).select(*key, "rawPrediction").collect()
    assert own == pytest.approx({tuple(r)[: len(key)]: r.rawPrediction[1] - r.rawPrediction[0] for r in votes})
    swapped = nodes.withColumns({"left": F.col("right"), "right": F.col("left")})
    other = {tuple(r)[: len(key)]: r.margin for r in model_tables.forest_margins(fitted.vectors, swapped, forest.getNumTrees, depth, *key).collect()}
    assert other != pytest.approx(own)


def test_a_vector_meets_the_rules_of_a_tree_once(spark, fitted):
    """Ten levels took eleven joins, each of which copied every vector for every tree."""
    name = classify.RANDOM_FOREST
    forest, key = fitted.models(name)[name].stages[-1], stages.row_key(fitted.vectors)
    nodes = model_tables.node_table(spark, fitted.ws.model(name), forest)
    plan = plan_of(model_tables.forest_margins(fitted.vectors, nodes, forest.getNumTrees, 10, *key))
    assert plan.count("BroadcastHashJoin") == 1


def test_sparse_and_dense_vectors_meet_the_same_weights(spark, fitted):
    model = fitted.models(SMALL[0])[SMALL[0]].stages[-1]
    width = model.numFeatures
    values = {1: 2.0, 3: -1.0, width - 1: 0.5}
    rows = [(0, Vectors.sparse(width, values)), (1, Vectors.dense([values.get(i, 0.0) for i in range(width)])), (2, Vectors.sparse(width, {}))]
    got = {r.id: r.margin for r in model_tables.linear_margins(spark.createDataFrame(rows, ["id", "features"]), model, "id").collect()}
    weights = model.coefficients.toArray()
    assert got[0] == pytest.approx(got[1]) == pytest.approx(sum(weights[i] * x for i, x in values.items()) + model.intercept)
    assert got[2] == pytest.approx(model.intercept)


# -- certificates ------------------------------------------------------------------


def test_wrong_components_are_noticed(spark):
    draw = np.random.default_rng(3)
    points = draw.normal(size=(400, 6)) * [5, 4, 3, 2, 1, 0.5] + 7
    df = spark.createDataFrame([(Vectors.dense(p.tolist()),) for p in points], ["features"])
    assert projection.covariance(df) == pytest.approx(np.cov(points.T))
    good = projection.fit_components(df)
    assert [(k, n, round(r, 9), round(o, 9)) for k, n, r, o in projection.certify(df, good)] == [(1, 0, 0, 0), (2, 1, 0, 0)]
    values, vectors = np.linalg.eigh(np.cov(points.T))
    third = projection.Components(vectors[:, [5, 3]], values[[5, 3]])
    assert [n for _, n, _, _ in projection.certify(df, third)] == [0, 2]
    tilted = projection.Components(good.vectors @ np.array([[1, 0.1], [0, 1]]), good.variances)
    assert projection.certify(df, tilted)[1][2] > 1e-3 and projection.certify(df, tilted)[1][3] > 1e-3


def test_passes_without_end_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(projection, "MAX_PASSES", 1)
    monkeypatch.setattr(projection, "EXTRA", 0)
    points = np.random.default_rng(4).normal(size=(60, 20))
    df = spark.createDataFrame([(Vectors.dense(p.tolist()),) for p in points], ["features"])
    with pytest.raises(RuntimeError):
        projection.fit_components(df)


def test_worse_boundaries_are_noticed(spark):
    draw = np.random.default_rng(5)
    rows = [(float(x), float(y), int(x + 0.5 * y + draw.normal() > 1)) for x, y in draw.normal(size=(500, 2)) * 3]
    points = spark.createDataFrame(rows, "PC1 double, PC2 double, label_index int")
    model = projection.fit_boundary(points)
    lines = projection.other_lines(model)
    assert tuple(projection.better_lines(points, model).first()) == (len(lines) - 1, 0)
    own = {r.line: r.objective for r in projection.objectives(points, lines, model.getRegParam()).collect()}
    x, sign = np.array([r[:2] for r in rows]), np.array([2 * r[2] - 1 for r in rows])
    for k, (a, b, c) in enumerate(lines):
        want = np.maximum(0, 1 - sign * (x @ [a, b] + c)).mean() + model.getRegParam() / 2 * (a * a + b * b)
        assert own[k] == pytest.approx(want)
    w, place = model.coefficients, model.intercept + 1.5

    class Shifted:
        coefficients, intercept = w, place

        def getRegParam(self):
            return model.getRegParam()

    assert projection.better_lines(points, Shifted()).first().n_better > 0


def test_tokens_are_stored_as_lines_and_read_as_arrays(spark, tmp_path):
    texts = [(1, "بيت كبير جدا بيت"), (2, None), (3, "x"), (4, "علم")]
    rows = spark.createDataFrame(texts, "doc_id long, text string").selectExpr("doc_id", "'original' AS generator", "'human' AS label", "text")
    ws = stages.Workspace(str(tmp_path))
    table = stages.build_features(tx.prepare(rows), ws)
    expected = {1: ["بيت", "كبير", "جدا", "بيت"], 2: [], 3: [], 4: ["علم"]}
    for read in (table, stages.open_table(spark, ws, "features")):
        assert dict(read.dtypes)["tokens"] == "array<string>"
        assert {r.doc_id: r.tokens for r in read.collect()} == expected
    assert dict(spark.read.parquet(ws.table("features")).dtypes)["tokens"] == "string"


@pytest.mark.parametrize("name", ["m1_count_vectorizer", "m2_idf"])
def test_weights_of_terms_need_no_stored_vectors(name, spark, sf, monkeypatch):
    monkeypatch.setattr(catalog.Stored, "_made", {})
    written, write = [], corpus.write_table
    for module in (stages, corpus):
        monkeypatch.setattr(module, "write_table", lambda df, path, *a, **k: written.append(path.rsplit("/", 1)[1]) or write(df, path, *a, **k))
    assert catalog.registered()[name](spark, sf).count() == 1000
    assert "vectors" not in written
