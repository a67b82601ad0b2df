import math

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import (
    IDF,
    HashingTF,
    Imputer,
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    Tokenizer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from sparkprep import COMPLAINTS
from sparkprep.functions import as_timestamp, column, day_difference, tokens
from sparkprep.operators import categories, numeric, text
from sparkprep.operators.stages import (
    DerivedFeatureGenerator,
    FrequencyEncoder,
    FrequencyEncoderModel,
    FrequencyImputer,
    FrequencyImputerModel,
)
from sparkprep.plans.features import apply_features, feature_stages, feature_table, fit_features
from sparkprep.plans.queries import QUERIES
from sparkprep.sources.tables import complaints
from sparkprep.workspace import settle

SF_DIR = "/root/testdata/sf0.001"


def test_malformed_dates_become_null(spark):
    df = spark.createDataFrame([("abc",), ("2023-08-10T12:00:00-05:00",), ("2023-08-10",)], "s string")
    found = [r["t"] for r in df.select(as_timestamp("s").cast("string").alias("t")).collect()]
    assert found == [None, "2023-08-10 17:00:00", "2023-08-10 00:00:00"]


def test_day_difference_is_absolute(spark):
    df = spark.createDataFrame(
        [("2023-01-02", "2023-01-01 12:00:00"), (None, "2023-01-01")], "a string, b string"
    )
    assert [r["d"] for r in df.select(day_difference("a", "b").alias("d")).collect()] == [0.5, None]


def test_mean_ignores_null_and_nan(spark):
    df = spark.createDataFrame([(1.0,), (None,), (math.nan,), (3.0,)], "x double")
    assert numeric.fit_means(df, ["x"]) == {"x": 2.0}
    assert sorted(r["y"] for r in numeric.impute_means(df, {"x": "y"}).collect()) == [1, 2, 2, 3]
    model = Imputer(inputCols=["x"], outputCols=["y"]).fit(df)
    assert sorted(r["y"] for r in model.transform(df).collect()) == [1, 2, 2, 3]


def test_mean_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "x double")
    with pytest.raises(ValueError, match="x"):
        numeric.fit_means(df, ["x"])
    assert numeric.fit_means(df, ["x"], default=0.0) == {"x": 0.0}


def test_scaling_matches_the_ml_stage(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, y double")
    found = numeric.scale_by_deviation(df, {"x": "sx", "y": "sy"}).orderBy("x")
    ours = [(r["sx"], r["sy"]) for r in found.collect()]
    vectors = VectorAssembler(inputCols=["x", "y"], outputCol="v").transform(df)
    scaler = StandardScaler(inputCol="v", outputCol="s").fit(vectors)
    theirs = [tuple(r["s"]) for r in scaler.transform(vectors).orderBy("x").collect()]
    assert ours == [pytest.approx(t) for t in theirs]
    assert ours[0] == pytest.approx((math.sqrt(0.5), 0.0))


TEXTS = ["a  b A ", " x y", "", "   ", "Tab\tnew\nline\x0bvt\r\n", "ÜBER Straße", "one"]


def test_tokens_match_the_ml_stage(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    ml = Tokenizer(inputCol="t", outputCol="w").transform(df)
    rows = ml.select("t", "w", tokens(F.col("t")).alias("ours")).collect()
    assert [r["ours"] for r in rows] == [r["w"] for r in rows]
    assert rows[0]["ours"] == ["a", "", "b", "a"]
    null = spark.createDataFrame([(None,)], "t string").select(tokens(F.col("t")).alias("w")).first()
    assert null["w"] == [""]


def test_tokens_match_on_all_documents(spark):
    df = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("text")
    ml = Tokenizer(inputCol="text", outputCol="w").transform(df)
    assert ml.where(F.col("w") != tokens(F.col("text"))).count() == 0


def test_term_counts_need_one_shuffle_of_raw_text(spark):
    df = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    plan = text.term_frequencies(df, "doc_id", "text")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert "Exchange hashpartitioning(doc_id" in plan


def test_hash_buckets(spark):
    words = {"credit": 31, "report": 25, "incorrect": 22, "information": 30, "ü": 28}
    df = spark.createDataFrame(list(words.items()), "t string, expected int")
    found = text.hashed_frequencies(df, "expected", "t")
    assert all(r["bucket"] == r["expected"] for r in found.collect())


def test_tfidf_matches_the_formula(spark):
    df = spark.createDataFrame([(1, "a b"), (2, "a"), (3, "c")], "id int, t string")
    found = {(r["id"], r["term"]): r["tfidf"] for r in text.tfidf_terms(df, "id", "t").collect()}
    assert found == {
        (1, "a"): pytest.approx(0.287682, abs=1e-6),
        (1, "b"): pytest.approx(0.693147, abs=1e-6),
        (2, "a"): pytest.approx(0.287682, abs=1e-6),
        (3, "c"): pytest.approx(0.693147, abs=1e-6),
    }


def test_tfidf_is_the_same_with_a_vocabulary_too_large_to_broadcast(spark):
    df = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    small = text.tfidf_terms(df, "doc_id", "text")
    large = text.tfidf_terms(df, "doc_id", "text", max_rows=50)
    assert small.exceptAll(large).count() == 0
    assert small.count() == large.count()


def test_hashed_tfidf_matches_own_terms_where_no_words_collide(spark):
    df = spark.createDataFrame([(1, "credit report"), (2, "credit"), (3, "incorrect")], "id int, t string")
    words = df.select("id", tokens(F.col("t")).alias("w"))
    hashed = HashingTF(inputCol="w", outputCol="tf", numFeatures=40).transform(words)
    vectors = IDF(inputCol="tf", outputCol="v").fit(hashed).transform(hashed)
    ml = {
        (r["id"], i): v for r in vectors.collect() for i, v in enumerate(r["v"].toArray()) if v
    }
    bucket = {"credit": 31, "report": 25, "incorrect": 22}
    ours = {
        (r["id"], bucket[r["term"]]): pytest.approx(r["tfidf"])
        for r in text.tfidf_terms(df, "id", "t").collect()
    }
    assert ml == ours


def test_index_and_one_hot_match_the_ml_stages(spark):
    df = complaints(spark, SF_DIR, "complaint_id", *COMPLAINTS.one_hot).dropna()
    counts = settle(categories.category_counts(df, COMPLAINTS.one_hot), "t")
    outputs = {c: f"si_{c}" for c in COMPLAINTS.one_hot}
    ours = categories.encode_index(df, settle(categories.index_labels(counts), "t"), outputs)
    ml = StringIndexer(
        inputCols=list(COMPLAINTS.one_hot), outputCols=[f"ml_{c}" for c in COMPLAINTS.one_hot]
    ).fit(df)
    both = ml.transform(ours)
    for c in COMPLAINTS.one_hot:
        assert both.where(F.col(f"ml_{c}") != F.col(f"si_{c}")).count() == 0


def test_derived_feature_stage(spark, tmp_path):
    df = spark.createDataFrame([("2023-01-01", "2023-01-03"), ("x", "2023-01-03")], "a string, b string")
    stage = DerivedFeatureGenerator(inputCols=["a", "b"], outputCols=["d"])
    stage.write().save(str(tmp_path / "s"))
    loaded = DerivedFeatureGenerator.load(str(tmp_path / "s"))
    assert [r["d"] for r in loaded.transform(df).collect()] == [2.0, None]
    assert loaded.setInputCols(["b", "a"]).getInputCols() == ["b", "a"]


def test_frequency_imputer_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("b", None), ("a", "x"), (None, "x")], "s string, t string")
    model = FrequencyImputer(inputCols=["s", "t"], outputCols=["o", "p"]).fit(df)
    assert model.getTopCategorys() == ["a", "x"]
    model.write().save(str(tmp_path / "m"))
    loaded = FrequencyImputerModel.load(str(tmp_path / "m"))
    assert [(r["o"], r["p"]) for r in loaded.transform(df).collect()] == [("b", "x"), ("a", "x"), ("a", "x")]


def test_frequency_imputer_checks_its_input(spark):
    df = spark.createDataFrame([(1, None)], "n int, s string")
    with pytest.raises(TypeError, match="n"):
        FrequencyImputer(inputCols=["n"], outputCols=["o"]).fit(df)
    with pytest.raises(ValueError, match="s"):
        FrequencyImputer(inputCols=["s"], outputCols=["o"]).fit(df)


def test_frequency_encoder_round_trip(spark, tmp_path):
    fitted = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "s string")
    applied = spark.createDataFrame([("a",), (None,), ("zz",)], "s string")
    model = FrequencyEncoder(inputCols=["s"], outputCols=["f"]).fit(fitted)
    path = str(tmp_path / "m")
    PipelineModel([model]).write().save(path)
    loaded = PipelineModel.load(path)
    expected = {"a": 2, None: 1, "zz": 0}
    for m in (model, loaded, model.copy()):
        assert {r["s"]: r["f"] for r in m.transform(applied).collect()} == expected
    inner = model.copy().setHow("inner")
    assert {r["s"]: r["f"] for r in inner.transform(applied).collect()} == {"a": 2}
    with pytest.raises(ValueError):
        FrequencyEncoderModel(inputCols=["s"], outputCols=["f"]).transform(applied)


@pytest.fixture(scope="module")
def accepted(spark):
    return settle(complaints(spark, SF_DIR), "accepted")


def test_feature_vectors_round_trip(spark, accepted, tmp_path):
    model = feature_stages(COMPLAINTS).fit(accepted.where("complaint_id % 3 > 0"))
    vectors = apply_features(model, accepted, COMPLAINTS, "complaint_id")
    assert vectors.columns == ["complaint_id", "scaled_input_features", "consumer_disputed"]
    assert vectors.count() == accepted.count()
    path = str(tmp_path / "model")
    model.write().overwrite().save(path)
    again = apply_features(PipelineModel.load(path), accepted, COMPLAINTS, "complaint_id")
    assert vectors.select("complaint_id", vector_to_array("scaled_input_features")).exceptAll(
        again.select("complaint_id", vector_to_array("scaled_input_features"))
    ).count() == 0


def test_fewer_passes_give_the_same_model(spark, accepted):
    train = accepted.where("complaint_id % 3 > 0")
    array = vector_to_array("scaled_input_features")
    ours, theirs = (
        apply_features(m, accepted, COMPLAINTS, "complaint_id").select("complaint_id", array.alias("v"))
        for m in (fit_features(train, COMPLAINTS), feature_stages(COMPLAINTS).fit(train))
    )
    both = ours.join(theirs.withColumnRenamed("v", "w"), "complaint_id")
    gap = F.array_max(F.zip_with("v", "w", lambda a, b: F.abs(a - b)))
    assert both.agg(F.max(gap)).first()[0] < 1e-9
    assert both.count() == accepted.count()


def test_fit_names_a_column_without_values(spark, accepted):
    empty = accepted.withColumn("submitted_via", F.lit(None).cast("string"))
    with pytest.raises(ValueError, match="submitted_via"):
        fit_features(empty, COMPLAINTS)


def test_prediction_rows_need_no_label(spark, accepted):
    model = feature_stages(COMPLAINTS).fit(accepted)
    unlabelled = accepted.select("complaint_id", *COMPLAINTS.required_for_prediction)
    assert apply_features(model, unlabelled, COMPLAINTS).columns == ["scaled_input_features"]


def test_unseen_category_and_missing_text_are_kept(spark, accepted):
    model = feature_stages(COMPLAINTS).fit(accepted)
    odd = accepted.limit(5).withColumns({"submitted_via": F.lit("zz"), "issue": F.lit(None).cast("string")})
    assert apply_features(model, odd, COMPLAINTS).count() == 5


def test_feature_table_matches_the_ml_stages(spark, accepted):
    ours = feature_table(accepted, COMPLAINTS)
    ml = feature_stages(COMPLAINTS).fit(accepted).transform(accepted)
    names = [*COMPLAINTS.imputed_numeric, *COMPLAINTS.indexed_one_hot]
    ml = ml.select("complaint_id", *(column(c).alias(f"ml_{c}") for c in names))
    both = ours.join(ml, "complaint_id")
    assert both.count() == accepted.count()
    for c in names:
        assert both.where(F.abs(F.col(c) - F.col(f"ml_{c}")) > 1e-9).count() == 0


def test_one_hot_query_matches_the_ml_stage(spark):
    long = QUERIES["feat_one_hot"](spark, SF_DIR)
    df = complaints(spark, SF_DIR, "complaint_id", *COMPLAINTS.one_hot)
    names = list(COMPLAINTS.one_hot)
    df = FrequencyImputer(inputCols=names, outputCols=list(COMPLAINTS.imputed_one_hot)).fit(df).transform(df)
    df = df.select("complaint_id", *(F.col(f"im_{c}").alias(c) for c in names))
    indexer = StringIndexer(
        inputCols=list(COMPLAINTS.one_hot), outputCols=list(COMPLAINTS.indexed_one_hot), handleInvalid="skip"
    )
    indexed = indexer.fit(df).transform(df)
    encoder = OneHotEncoder(
        inputCols=list(COMPLAINTS.indexed_one_hot), outputCols=list(COMPLAINTS.encoded_one_hot)
    )
    vectors = encoder.fit(indexed).transform(indexed)
    entries = vectors.select(
        sum(F.aggregate(vector_to_array(c), F.lit(0.0), lambda a, x: a + x) for c in COMPLAINTS.encoded_one_hot).alias("n")
    )
    assert entries.agg(F.sum("n")).first()[0] == long.count()
