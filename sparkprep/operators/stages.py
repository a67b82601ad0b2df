"""Pipeline stages for the operators that ``pyspark.ml`` lacks."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame

from sparkprep.functions import as_timestamp, day_difference
from sparkprep.operators import categories
from sparkprep.workspace import settle


class _Columns(HasInputCols, HasOutputCols):
    """Input and output column setters shared by the stages."""

    def setInputCols(self, value: list[str]):
        return self._set(inputCols=value)

    def setOutputCols(self, value: list[str]):
        return self._set(outputCols=value)

    def _outputs(self) -> dict[str, str]:
        inputs, outputs = self.getInputCols(), self.getOutputCols()
        if len(inputs) != len(outputs):
            raise ValueError(f"{len(inputs)} input columns but {len(outputs)} output columns")
        return dict(zip(inputs, outputs))


class DerivedFeatureGenerator(Transformer, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Casts two columns to timestamps and adds their absolute difference in days."""

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, outputCols: list[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        start, end = self.getInputCols()
        (output,) = self.getOutputCols()
        casted = dataset.withColumns({c: as_timestamp(c) for c in (start, end)})
        return casted.withColumn(output, day_difference(start, end))


class FrequencyImputer(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Replaces NULL by each column's most frequent value; all columns are fitted in one pass."""

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, outputCols: list[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> FrequencyImputerModel:
        names = self.getInputCols()
        other = [c for c in names if dataset.schema[c].dataType.typeName() != "string"]
        if other:
            raise TypeError(f"FrequencyImputer fills string columns only, not {other}")
        found = categories.modes(categories.category_counts(dataset, names))
        empty = [c for c in names if c not in found]
        if empty:
            raise ValueError(f"no value to impute from in {empty}")
        model = FrequencyImputerModel(inputCols=names, outputCols=self.getOutputCols())
        return model.setTopCategorys([found[c] for c in names])


class FrequencyImputerModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    topCategorys = Param(
        Params._dummy(),
        "topCategorys",
        "most frequent value of each input column",
        typeConverter=TypeConverters.toListString,
    )

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, outputCols: list[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def setTopCategorys(self, value: list[str]) -> FrequencyImputerModel:
        return self._set(topCategorys=value)

    def getTopCategorys(self) -> list[str]:
        return self.getOrDefault(self.topCategorys)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        values = dict(zip(self.getInputCols(), self.getTopCategorys()))
        return categories.impute_modes(dataset, values, self._outputs())


class _HasJoin(Params):
    how = Param(
        Params._dummy(),
        "how",
        "'left' keeps rows with unfitted categories and counts them 0, 'inner' drops them",
        typeConverter=TypeConverters.toString,
    )

    def setHow(self, value: str):
        return self._set(how=value)

    def getHow(self) -> str:
        return self.getOrDefault(self.how)


class FrequencyEncoder(Estimator, _Columns, _HasJoin, DefaultParamsReadable, DefaultParamsWritable):
    """Replaces categories by how often they were seen when fitting."""

    @keyword_only
    def __init__(
        self,
        *,
        inputCols: list[str] | None = None,
        outputCols: list[str] | None = None,
        how: str = "left",
    ):
        super().__init__()
        self._setDefault(how="left")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> FrequencyEncoderModel:
        counts = settle(categories.category_counts(dataset, self.getInputCols()), "frequencies")
        model = FrequencyEncoderModel(
            inputCols=self.getInputCols(), outputCols=self.getOutputCols(), how=self.getHow()
        )
        return model.setFrequencies(counts)


class FrequencyEncoderModel(Model, _Columns, _HasJoin, MLReadable, MLWritable):
    """Holds the fitted counts as a table, so high cardinality never meets the driver."""

    @keyword_only
    def __init__(
        self,
        *,
        inputCols: list[str] | None = None,
        outputCols: list[str] | None = None,
        how: str = "left",
    ):
        super().__init__()
        self._setDefault(how="left")
        self._set(**self._input_kwargs)
        self._frequencies: DataFrame | None = None

    def setFrequencies(self, counts: DataFrame) -> FrequencyEncoderModel:
        self._frequencies = counts
        return self

    @property
    def frequencies(self) -> DataFrame:
        """``(column, category, n)``."""
        if self._frequencies is None:
            raise ValueError("the model holds no frequencies; fit or load it first")
        return self._frequencies

    def copy(self, extra=None) -> FrequencyEncoderModel:
        return super().copy(extra).setFrequencies(self._frequencies)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return categories.encode_frequency(
            dataset, self.frequencies, self._outputs(), how=self.getHow()
        )

    def write(self) -> MLWriter:
        return _FrequencyWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _FrequencyReader()


class _FrequencyWriter(MLWriter):
    def __init__(self, model: FrequencyEncoderModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.frequencies.write.parquet(f"{path}/frequencies")


class _FrequencyReader(MLReader):
    def load(self, path: str) -> FrequencyEncoderModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = FrequencyEncoderModel()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model.setFrequencies(self.sparkSession.read.parquet(f"{path}/frequencies"))
