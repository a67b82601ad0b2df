"""A whole run: load what is new, validate it, and write the feature tables.

Stages hand over parquet paths, so a run can stop after any stage and resume from its output.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkprep.functions import column
from sparkprep.operators import sampling, validate, windows
from sparkprep.plans.features import apply_features, fit_features
from sparkprep.schema import COMPLAINTS, SchemaSpec
from sparkprep.sources import landing, store, watermark
from sparkprep.streaming import stage_new_files, stream_landing
from sparkprep.workspace import discard, scratch

# Fixed value: nothing received before this day is loaded by default.
MIN_START = date(2023, 5, 1)


@dataclass(frozen=True)
class RunConfig:
    root: str
    run_id: str
    landing: str
    spec: SchemaSpec = field(default=COMPLAINTS)
    from_date: date = MIN_START
    to_date: date | None = None
    min_start: date = MIN_START
    missing_threshold: float = 0.4
    row_cap: int | None = None
    balanced: bool = False
    test_size: float = 0.3
    unseen: str = "keep"
    whole_files: bool = False

    @property
    def store(self) -> str:
        return f"{self.root}/feature_store"

    @property
    def watermark(self) -> str:
        return f"{self.root}/watermark"

    @property
    def progress(self) -> str:
        """Which landed files have been read."""
        return f"{self.root}/progress"

    @property
    def staging(self) -> str:
        """What was parsed and is not yet loaded."""
        return f"{self.root}/staging"

    def output(self, name: str) -> str:
        return f"{self.root}/runs/{self.run_id}/{name}"


@dataclass(frozen=True)
class Ingested:
    store: str
    quarantine: str
    undated: str
    unkeyed: str
    early: str
    from_date: date
    to_date: date


@dataclass(frozen=True)
class Validated:
    accepted: str
    rejected: str
    n_rows: int


@dataclass(frozen=True)
class Transformed:
    train: str
    test: str
    model: str
    n_train: int
    n_test: int


def ingest(spark: SparkSession, config: RunConfig) -> Ingested:
    """Append what has landed since the last run to the store, then move the watermark.

    Only files that no run has read are parsed. Every record with a key and a date from ``min_start``
    on is stored, however late it lands; ``to_date`` holds when the store is read. Others go to tables
    of the run: text that is no JSON to the quarantine, and records without a key, without a readable
    date, or from before ``min_start`` to ``unkeyed``, ``undated`` and ``early``. The watermark moves
    only after all writes have committed. A run that failed half-way is repeated: what it had parsed is
    still staged, and loading it again adds nothing.
    """
    spec = config.spec
    first, last = windows.resolve_span(
        config.from_date,
        config.to_date,
        config.min_start,
        watermark.latest(spark, config.watermark),
    )
    names = ("quarantine", "undated", "unkeyed", "early")
    done = Ingested(config.store, *map(config.output, names), first, last)
    if first >= last:
        return done
    stream = stream_landing(spark, config.landing, spec.landing, config.whole_files)
    landed = stage_new_files(stream, config.staging, config.progress)
    if landed is not None:
        landing.corrupt(landed).write.mode("overwrite").parquet(done.quarantine)
        payloads = landing.unwrap(landed)
        parts = store.sorted_records(payloads, spec.key, spec.date_end, config.min_start)
        for name in names[1:]:
            parts[name].write.mode("overwrite").parquet(config.output(name))
        records = landing.typed(parts["store"], spec)
        store.append_to_store(records, config.store, spec.key, spec.date_end)
    watermark.advance(spark, config.watermark, first, last, config.store)
    discard(spark, config.staging)
    return done


def read_store(spark: SparkSession, config: RunConfig, before: date) -> DataFrame:
    """The stored records received before a day."""
    df = store.read_table(spark, config.store, config.spec.stored)
    return df.where(column(config.spec.date_end) < F.lit(before)).drop(store.MONTH)


def validate_store(spark: SparkSession, config: RunConfig, ingested: Ingested) -> Validated:
    """Write sparse and unwanted columns apart and the others, with the key, as accepted."""
    spec = config.spec
    df = read_store(spark, config, ingested.to_date)
    df = sampling.take(df, spec.key, config.row_cap)
    reasons = validate.columns_to_reject(df, spec.unwanted, config.missing_threshold)
    accepted = validate.accepted_columns(df, reasons, keep=[spec.key])
    validate.require_columns(accepted, spec.required)
    rejected_path, accepted_path = config.output("rejected"), config.output("accepted")
    store.append_rejects(validate.rejected_columns(df, reasons, spec.key), rejected_path)
    return Validated(accepted_path, rejected_path, store.write_once(accepted, accepted_path))


def transform(spark: SparkSession, config: RunConfig, validated: Validated) -> Transformed:
    """Fit the features on the training side, and write the model and both feature tables."""
    spec = config.spec
    df = store.read_table(spark, validated.accepted)
    if config.balanced:
        # no shuffle: the split below goes by key digests, as an order by them would
        df = sampling.balance(df, spec.key, spec.target)
    train, test = sampling.split(df, spec.key, config.test_size)
    model = fit_features(train, spec, config.unseen)
    paths = [config.output(name) for name in ("train", "test", "model")]
    model.write().overwrite().save(paths[2])
    sizes = [
        store.write_once(apply_features(model, side, spec), path)
        for side, path in zip((train, test), paths)
    ]
    return Transformed(*paths, *sizes)


def run(spark: SparkSession, config: RunConfig) -> Transformed:
    """All stages. What they settled on the way is deleted at the end, also after a failure."""
    with scratch(spark):
        return transform(spark, config, validate_store(spark, config, ingest(spark, config)))
