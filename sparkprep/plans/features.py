"""The feature plans: a relational feature table and the twelve-step ML pipeline."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    IDF,
    HashingTF,
    Imputer,
    OneHotEncoder,
    SQLTransformer,
    StandardScaler,
    StringIndexer,
    StringIndexerModel,
    Tokenizer,
    VectorAssembler,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkprep.functions import column, day_difference
from sparkprep.operators.categories import (
    category_counts,
    encode_index,
    fold_missing,
    impute_modes,
    index_labels,
    modes,
    require_modes,
)
from sparkprep.operators.numeric import impute_means
from sparkprep.operators.stages import (
    DerivedFeatureGenerator,
    FrequencyImputer,
    FrequencyImputerModel,
)
from sparkprep.schema import SchemaSpec
from sparkprep.workspace import settle

HASHED_TEXT_WIDTH = 40
MAX_ONE_HOT = 1_000_000
"""Labels of all one-hot columns together: the model holds them, so more are refused."""


def feature_table(df: DataFrame, spec: SchemaSpec, *categories: str) -> DataFrame:
    """Key, mean-filled day difference, and mode-filled and indexed categories, as plain columns.

    One pass counts the categories; modes and index positions both follow from those counts.
    """
    names = list(categories or spec.one_hot)
    imputed = {c: f"im_{c}" for c in names}
    counts = settle(category_counts(df, names), "category-counts")
    values = modes(counts)
    require_modes(values, names)
    folded = fold_missing(counts, values).withColumn("column", F.concat(F.lit("im_"), "column"))
    labels = settle(index_labels(settle(folded, "folded-counts")), "labels")
    base = df.select(
        column(spec.key),
        day_difference(spec.date_start, spec.date_end).alias(spec.day_difference),
        *(column(c) for c in names),
    )
    filled = impute_means(base, {c: f"im_{c}" for c in spec.numeric})
    filled = impute_modes(filled, values, imputed).drop(*spec.numeric, *names)
    return encode_index(filled, labels, {f"im_{c}": f"si_{c}" for c in names})


def feature_stages(
    spec: SchemaSpec,
    unseen: str = "keep",
    text_width: int = HASHED_TEXT_WIDTH,
    imputer: FrequencyImputer | FrequencyImputerModel | None = None,
    indexers: Sequence[StringIndexer | StringIndexerModel] = (),
) -> Pipeline:
    """Day difference, fills, indexing, one-hot, hashed TF-IDF, assembly and scaling.

    ``unseen`` is what indexing does with a category it was not fitted on: ``keep`` gives it a
    bucket of its own, ``error`` fails. Missing text counts as empty. ``imputer`` and ``indexers``
    stand in for the category stages, for instance fitted ones.
    """
    text = f"_filled_{spec.text}"
    filled_text = SQLTransformer(
        statement=f"SELECT *, coalesce(`{spec.text}`, '') AS `{text}` FROM __THIS__"
    )
    imputer = imputer or FrequencyImputer(
        inputCols=list(spec.one_hot), outputCols=list(spec.imputed_one_hot)
    )
    indexers = indexers or [
        StringIndexer(
            inputCols=list(spec.imputed_one_hot),
            outputCols=list(spec.indexed_one_hot),
            handleInvalid=unseen,
        )
    ]
    return Pipeline(
        stages=[
            DerivedFeatureGenerator(
                inputCols=[spec.date_start, spec.date_end], outputCols=list(spec.numeric)
            ),
            Imputer(inputCols=list(spec.numeric), outputCols=list(spec.imputed_numeric)),
            imputer,
            *indexers,
            OneHotEncoder(
                inputCols=list(spec.indexed_one_hot), outputCols=list(spec.encoded_one_hot)
            ),
            filled_text,
            Tokenizer(inputCol=text, outputCol="words"),
            HashingTF(inputCol="words", outputCol="rawFeatures", numFeatures=text_width),
            IDF(inputCol="rawFeatures", outputCol=spec.encoded_text),
            VectorAssembler(
                inputCols=list(spec.assembled_inputs), outputCol=spec.assembled, handleInvalid="error"
            ),
            StandardScaler(inputCol=spec.assembled, outputCol=spec.scaled),
        ]
    )


def fit_features(
    train: DataFrame,
    spec: SchemaSpec,
    unseen: str = "keep",
    text_width: int = HASHED_TEXT_WIDTH,
) -> PipelineModel:
    """The model that ``feature_stages(...).fit(train)`` gives, with fewer passes over ``train``.

    Modes and index labels of all the categories come from one distributed count instead of two
    passes. Only the labels reach the driver, as many as the one-hot vectors are wide, and their number
    is checked first.
    """
    names = list(spec.one_hot)
    counts = settle(category_counts(train, names), "category-counts")
    values = modes(counts)
    require_modes(values, names)
    imputer = FrequencyImputerModel(inputCols=names, outputCols=list(spec.imputed_one_hot))
    imputer.setTopCategorys([values[c] for c in names])

    ordered = settle(index_labels(settle(fold_missing(counts, values), "folded-counts")), "labels")
    width = ordered.count()
    if width > MAX_ONE_HOT:
        raise ValueError(f"{width} labels in {names}; one-hot vectors hold {MAX_ONE_HOT} at most")
    labels: dict[str, list[str]] = {c: [] for c in names}
    for row in ordered.orderBy("column", "position").collect():
        labels[row["column"]].append(row["category"])
    # One model per column: a shared one pads label lists of different lengths with nulls.
    indexers = [
        StringIndexerModel.from_labels(labels[c], f"im_{c}", f"si_{c}", handleInvalid=unseen)
        for c in names
    ]
    return feature_stages(spec, unseen, text_width, imputer, indexers).fit(train)


def apply_features(model: PipelineModel, df: DataFrame, spec: SchemaSpec, *keep: str) -> DataFrame:
    """The scaled vector and, where the table has it, the label, next to the columns in ``keep``."""
    label = [column(spec.target)] if spec.target in df.columns else []
    return model.transform(df).select(*(column(c) for c in keep), column(spec.scaled), *label)
