"""The registered queries: each operator run over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date

from pyspark.ml import PipelineModel
from pyspark.ml.feature import IDF, HashingTF, OneHotEncoder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkprep.functions import as_timestamp, column, day_difference, stored_entries, tokens
from sparkprep.operators import categories, evaluate, numeric, profile, running, sampling, stages, text
from sparkprep.operators import validate
from sparkprep.operators import windows
from sparkprep.plans import training
from sparkprep.plans.features import apply_features, feature_table, fit_features
from sparkprep.schema import COMPLAINTS
from sparkprep.sources import landing, store, watermark
from sparkprep.sources.key_index import KeyIndex
from sparkprep.sources.tables import VIEW_COLUMNS, complaints, documents, table
from sparkprep.streaming import load_new_files, stream_landing, stream_to_store
from sparkprep.workspace import new_path, settle

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

KEY = COMPLAINTS.key
MODES = {c: f"im_{c}" for c in COMPLAINTS.one_hot}


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


def rounded(*names: str) -> list:
    return [F.round(F.col(c), 6).alias(c) for c in names]


def day(name: str):
    return F.date_format(column(name), "yyyy-MM-dd").alias(name)


# --- sources ---------------------------------------------------------------------------------


@query
def src_parquet_scan(spark, sf_dir):
    return complaints(spark, sf_dir)


@query
def src_json_landing(spark, sf_dir):
    """Complaints landed as JSON envelopes, read back with the declared schema."""
    path = new_path(spark, "landing")
    fields = (KEY, "company_response", "issue", "date_received")
    records = complaints(spark, sf_dir, *fields)
    records.select(F.struct(*fields).alias(landing.ENVELOPE)).write.json(path)
    landed = landing.read_landing(spark, path, COMPLAINTS.landing, whole_files=False)
    read = landing.typed(landing.unwrap(landed), COMPLAINTS)
    return read.select(
        F.col(KEY).cast("long").alias(KEY), "company_response", "issue", day("date_received")
    )


@query
def src_envelope_unwrap(spark, sf_dir):
    """Event properties inside an envelope; errors come without one and are skipped."""
    body = F.when(F.col("event_type") == "error", F.lit('{"detail": "none"}')).otherwise(
        F.concat(F.lit('{"_source": '), F.col("props"), F.lit("}"))
    )
    events = table(spark, sf_dir, "events").select("event_id", body.alias("body"))
    payload = spark.createDataFrame([], "k long").schema
    return landing.unwrap_text(events, "body", payload, "event_id")


def _landed_events(spark, sf_dir) -> str:
    """Events landed as lines: errors as plain text, clicks as JSON without a payload."""
    line = (
        F.when(F.col("event_type") == "error", F.lit("Throttled. Expected available in 42 seconds."))
        .when(F.col("event_type") == "click", F.to_json(F.struct("event_id")))
        .otherwise(F.to_json(F.struct(F.struct("event_id", "user_id", "event_type").alias("_source"))))
    )
    path = new_path(spark, "events")
    table(spark, sf_dir, "events").select(line.alias("value")).write.text(path)
    return path


EVENT_PAYLOAD = "event_id long, user_id long, event_type string"


@query
def src_quarantine_count(spark, sf_dir):
    payload = spark.createDataFrame([], EVENT_PAYLOAD).schema
    landed = landing.read_landing(spark, _landed_events(spark, sf_dir), payload, whole_files=False)
    return landing.outcome_counts(landed)


@query
def src_quarantine_rows(spark, sf_dir):
    """The dead-letter rows of a streamed load over several micro-batches, read back."""
    root, payload = new_path(spark, "load"), spark.createDataFrame([], EVENT_PAYLOAD + ", ts string").schema
    _stream_events(spark, sf_dir, root, payload)
    found = spark.read.parquet(f"{root}/quarantine")
    return found.groupBy("content", "partly_parsed").agg(F.count(F.lit(1)).alias("n"))


@query
def stream_store_rows(spark, sf_dir):
    """What a streamed load over several micro-batches has put in the store, and beside it."""
    root, payload = new_path(spark, "load"), spark.createDataFrame([], EVENT_PAYLOAD + ", ts string").schema
    _stream_events(spark, sf_dir, root, payload)
    parts = [spark.read.parquet(f"{root}/store").select("event_id", F.lit("store").alias("place"))]
    for name in ("unkeyed", "undated", "early"):
        parts.append(spark.read.parquet(f"{root}/{name}").select("event_id", F.lit(name).alias("place")))
    return sampling.union_by_name(parts)


def _stream_events(spark, sf_dir, root: str, payload) -> None:
    """Events as lines in three files, one to a micro-batch: errors as plain text, some without a date."""
    moment = F.when(F.col("event_id") % 10 != 3, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    record = F.struct("event_id", "user_id", "event_type", moment.alias("ts"))
    line = F.when(F.col("event_type") == "error", F.lit("Throttled. Expected available in 42 seconds."))
    line = line.otherwise(F.to_json(F.struct(record.alias("_source"))))
    events = table(spark, sf_dir, "events").select(line.alias("value"))
    events.repartition(3).write.text(f"{root}/landing")
    stream_to_store(
        stream_landing(spark, f"{root}/landing", payload, max_files=1), f"{root}/progress", root=root,
        store=f"{root}/store", key="event_id", received="ts",
    )


@query
def src_feature_store(spark, sf_dir):
    """Two loads that overlap by a quarter, with each record stored once."""
    path = new_path(spark, "store")
    records = complaints(spark, sf_dir, KEY, "date_received", "company_response")
    early = windows.time_slice(records, "date_received", date(1900, 1, 1), date(1997, 7, 1))
    late = windows.time_slice(records, "date_received", date(1997, 4, 1), date(2100, 1, 1))
    for batch in (early, late):
        store.append_to_store(batch, path, KEY, "date_received")
    stored = store.read_table(spark, path)
    return stored.select(KEY, "company_response", F.col(store.MONTH).cast("string").alias(store.MONTH))


@query
def src_store_keys(spark, sf_dir):
    """The clustered index of a store's keys after two loads that overlap, the second done twice."""
    path = new_path(spark, "store")
    records = complaints(spark, sf_dir, KEY, "date_received", "company_response")
    for first, last in ((1900, 1997), (1996, 2100), (1996, 2100)):
        batch = windows.time_slice(records, "date_received", date(first, 1, 1), date(last, 1, 1))
        store.append_to_store(batch, path, KEY, "date_received")
    return KeyIndex(spark, store.index_path(path), records.schema[KEY]).keys()


# --- load windows ----------------------------------------------------------------------------


@query
def inc_watermark_max(spark, sf_dir):
    loads = windows.plan_windows(windows.span(table(spark, sf_dir, "orders"), "o_orderdate"))
    return loads.agg(F.max("to_date").alias("watermark")).select(day("watermark"))


@query
def inc_granularity(spark, sf_dir):
    bounds = windows.span(table(spark, sf_dir, "orders"), "o_orderdate")
    unit = windows.granularity(F.col("from_date"), F.col("to_date")).alias("granularity")
    return bounds.select(day("from_date"), day("to_date"), unit)


@query
def inc_windows(spark, sf_dir):
    planned = windows.plan_windows(windows.span(table(spark, sf_dir, "orders"), "o_orderdate"))
    return planned.select("granularity", day("from_date"), day("to_date"))


@query
def inc_window_counts(spark, sf_dir):
    counted = windows.window_counts(table(spark, sf_dir, "orders"), "o_orderdate")
    return counted.select(day("from_date"), day("to_date"), "n")


@query
def inc_window_counts_sent(spark, sf_dir):
    """Over a date that some rows lack: those are in no window."""
    counted = windows.window_counts(complaints(spark, sf_dir, KEY, "date_sent_to_company"), "date_sent_to_company")
    return counted.select(day("from_date"), day("to_date"), "n")


def _land(records: DataFrame, path: str) -> None:
    records.select(F.struct("*").alias(landing.ENVELOPE)).write.mode("append").json(path)


def _run_config(spark, **changes) -> training.RunConfig:
    root = new_path(spark, "run")
    settings = {
        "root": root, "run_id": "first", "landing": f"{root}/landing", "from_date": date(1900, 1, 1),
        "to_date": date(2100, 1, 1), "min_start": date(1993, 1, 1), **changes,
    }
    return training.RunConfig(**settings)


@query
def inc_resume(spark, sf_dir):
    """Orders landed in two parts, the second with late ones, and loaded twice each.

    Every twentieth record has no key and every thirtieth no readable date. What is returned is where
    each record ended: the store, or a table of the run that met it.
    """
    first = _run_config(spark, to_date=date(1996, 1, 1))
    second = replace(first, run_id="second", to_date=date(2100, 1, 1))
    received = F.date_format("date_received", "yyyy-MM-dd")
    records = complaints(spark, sf_dir, KEY, "date_received").select(
        F.when(F.col(KEY) % 20 != 0, F.col(KEY).cast("string")).alias(KEY),
        F.when(F.col(KEY) % 30 != 1, received).otherwise("soon").alias("date_received"),
        F.col(KEY).cast("string").alias("issue"),
        F.col(KEY).alias("_number"),
        F.col("date_received").alias("_received"),
    )
    early = (F.col("_received") < F.lit(date(1996, 1, 1))) & (F.col("_number") % 7 != 0)
    for config, part in ((first, records.where(early)), (second, records.where(~early))):
        _land(part.drop("_number", "_received"), config.landing)
        for _ in range(2):
            training.ingest(spark, config)
    stored = training.read_store(spark, second, date(2100, 1, 1)).select(F.lit("store").alias("place"), "issue")
    sides = [
        spark.read.parquet(config.output(name)).select(F.lit(name).alias("place"), "issue")
        for config in (first, second)
        for name in ("unkeyed", "undated", "early")
    ]
    found = sampling.union_by_name([stored, *sides])
    return found.select("place", F.col("issue").cast("long").alias(KEY))


@query
def inc_watermark_table(spark, sf_dir):
    """The watermark table after three loads, and the range that the next load would take."""
    path, orders = new_path(spark, "watermark"), table(spark, sf_dir, "orders")
    last = orders.agg(F.max("o_orderdate").cast("date")).first()[0]
    for first, to in ((date(1990, 1, 1), date(1995, 1, 1)), (date(1995, 1, 1), last), (date(1994, 1, 1), last)):
        watermark.advance(spark, path, first, to, "store")
    following, _ = windows.resolve_span(date(1990, 1, 1), None, None, watermark.latest(spark, path))
    marks = watermark.watermarks(spark, path)
    return marks.select(day("from_date"), day("to_date"), F.lit(str(following)).alias("next_from"))


@query
def inc_window_counts_events(spark, sf_dir):
    counted = windows.window_counts(table(spark, sf_dir, "events"), "ts")
    return counted.select(day("from_date"), day("to_date"), "n")


@query
def inc_window_extract(spark, sf_dir):
    """Orders written by load window; the last window comes late and incomplete, and is loaded again."""
    path, orders = new_path(spark, "windows"), table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    bounds = windows.span(orders, "o_orderdate").first()
    planned = windows.plan_windows(windows.fixed_span(spark, *bounds)).orderBy("from_date").collect()
    first, unit, last = bounds["from_date"], planned[0]["granularity"], planned[-1]
    late = (F.col("o_orderdate") >= F.lit(last["from_date"])) & (F.col("o_orderkey") % 3 == 0)
    windows.write_windows(orders.where(~late), "o_orderdate", path, first, unit)
    window = (last["from_date"], last["to_date"])
    windows.rewrite_window(orders, "o_orderdate", path, window, first, unit)
    return spark.read.parquet(path).select("o_orderkey", day(windows.WINDOW))


# --- state by load ---------------------------------------------------------------------------


def _recorded(spark, sf_dir, columns, fit) -> DataFrame:
    """The states of two loads, one of them recorded again after it was recorded from fewer records."""
    path, df = new_path(spark, "state"), settle(complaints(spark, sf_dir, KEY, *columns), "records")
    early, late = df.where(F.col(KEY) % 4 != 0), df.where(F.col(KEY) % 4 == 0)
    for load, part in (("early", early), ("late", late.where(F.col(KEY) % 3 == 0)), ("late", late)):
        running.record(fit(part, columns), path, load)
    return running.recorded(spark, path)


@query
def inc_merged_counts(spark, sf_dir):
    """Category counts of two loads, merged."""
    return running.merge_counts(_recorded(spark, sf_dir, COMPLAINTS.one_hot, categories.category_counts))


@query
def inc_merged_modes(spark, sf_dir):
    """Modes that follow from merged counts."""
    states = _recorded(spark, sf_dir, COMPLAINTS.one_hot, categories.category_counts)
    return categories.most_frequent(running.merge_counts(states))


@query
def inc_merged_moments(spark, sf_dir):
    """Counts, means and deviations of two loads, merged; over numbers that lie far from zero too."""
    path = new_path(spark, "state")
    df = settle(table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.col("l_extendedprice").cast("double").alias("price"),
        (F.col("l_quantity").cast("double") + 1e9).alias("far"),
        F.when(F.col("l_orderkey") % 5 == 0, F.col("l_linenumber").cast("double")).alias("sparse"),
    ), "numbers")
    for load, part in (("a", df.where("l_orderkey % 3 = 0")), ("b", df.where("l_orderkey % 3 = 1")),
                       ("c", df.where("l_orderkey % 3 = 1")), ("c", df.where("l_orderkey % 3 = 2"))):
        running.record(running.moments(part, ["price", "far", "sparse"]), path, load)
    merged = running.merge_moments(running.recorded(spark, path))
    return merged.select("column", "n", F.round("mean", 4).alias("mean"), F.round("deviation", 4).alias("deviation"))


@query
def inc_merged_distinct(spark, sf_dir):
    """Exact distinct counts, and whether the merged sketches of two loads are near them."""
    names = [c for c in VIEW_COLUMNS if c != KEY]
    merged = running.merge_distinct(_recorded(spark, sf_dir, names, running.distinct_state))
    exact = profile.unique_profile(complaints(spark, sf_dir), names).select("column", F.col("n_unique").alias("exact"))
    near = F.abs(F.col("n_unique") - F.col("exact")) <= F.greatest(F.lit(1.0), 0.05 * F.col("exact"))
    return merged.join(exact, "column").select(
        "column", F.col("exact").alias("n_unique"), "missing_row", near.alias("within")
    )


@query
def inc_slice(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return windows.time_slice(orders, "o_orderdate", date(1997, 1, 1), date(1998, 1, 1))


# --- profile and validation ------------------------------------------------------------------


@query
def val_row_cap(spark, sf_dir):
    return sampling.take(complaints(spark, sf_dir, KEY, "company_response"), KEY, 10_000)


@query
def val_shape(spark, sf_dir):
    return profile.shape(complaints(spark, sf_dir))


@query
def val_missing_report(spark, sf_dir):
    report = profile.missing_report(complaints(spark, sf_dir))
    return report.select("column", "total_row", "missing_row", *rounded("missing_percentage"))


@query
def val_high_missing(spark, sf_dir):
    report = profile.high_missing(profile.missing_report(complaints(spark, sf_dir)))
    return report.select("column", "total_row", "missing_row", *rounded("missing_percentage"))


@query
def val_reject(spark, sf_dir):
    df = complaints(spark, sf_dir)
    return validate.rejected_columns(df, validate.columns_to_reject(df, COMPLAINTS.unwanted), KEY)


@query
def val_accepted(spark, sf_dir):
    df = complaints(spark, sf_dir)
    kept = validate.accepted_columns(df, validate.columns_to_reject(df, COMPLAINTS.unwanted))
    return validate.require_columns(kept, COMPLAINTS.required)


@query
def val_unique_profile(spark, sf_dir):
    found = profile.unique_profile(complaints(spark, sf_dir))
    return found.select("column", "n_unique", "missing_row", *rounded("missing_percentage"))


@query
def val_unique_profile_approx(spark, sf_dir):
    """Exact distinct counts, and whether the estimates are near them."""
    return profile.approx_within(complaints(spark, sf_dir))


@query
def val_labelled(spark, sf_dir):
    return validate.labelled(complaints(spark, sf_dir, KEY, COMPLAINTS.target), COMPLAINTS.target)


# --- features --------------------------------------------------------------------------------


@query
def feature_table_query(spark, sf_dir):
    """Over the written table, so that its three passes do not repeat the joins behind it."""
    needed = (KEY, COMPLAINTS.date_start, COMPLAINTS.date_end, *COMPLAINTS.one_hot)
    features = feature_table(settle(complaints(spark, sf_dir, *needed), "accepted"), COMPLAINTS)
    return features.withColumns({c: F.round(c, 6) for c in COMPLAINTS.imputed_numeric})


QUERIES["feature_table"] = QUERIES.pop("feature_table_query")


@query
def feat_cast_ts(spark, sf_dir):
    """Receipt dates as text, every eleventh malformed."""
    written = F.when(F.col(KEY) % 11 == 0, F.lit("not a date")).otherwise(
        F.date_format("date_received", "yyyy-MM-dd HH:mm:ss")
    )
    df = complaints(spark, sf_dir, KEY, "date_received").select(KEY, written.alias("written"))
    return df.select(KEY, as_timestamp("written").cast("timestamp_ntz").alias("received"))


def _differences(spark, sf_dir) -> DataFrame:
    days = day_difference(COMPLAINTS.date_start, COMPLAINTS.date_end)
    df = complaints(spark, sf_dir, KEY, COMPLAINTS.date_start, COMPLAINTS.date_end)
    return df.select(KEY, days.alias("diff_in_days"))


@query
def feat_day_diff(spark, sf_dir):
    return _differences(spark, sf_dir).select(KEY, *rounded("diff_in_days"))


@query
def feat_mean_impute(spark, sf_dir):
    filled = numeric.impute_means(_differences(spark, sf_dir), {"diff_in_days": "im_diff_in_days"})
    return filled.select(KEY, *rounded("im_diff_in_days"))


@query
def feat_scaled_numeric(spark, sf_dir):
    df = _differences(spark, sf_dir)
    scaled = numeric.scale_by_deviation(df, {"diff_in_days": "scaled_diff_in_days"})
    return scaled.select(KEY, *rounded("scaled_diff_in_days"))


def _categories(spark, sf_dir) -> DataFrame:
    return complaints(spark, sf_dir, KEY, *COMPLAINTS.one_hot)


@query
def feat_mode_fit(spark, sf_dir):
    counts = categories.category_counts(_categories(spark, sf_dir), COMPLAINTS.one_hot)
    return categories.most_frequent(counts)


@query
def feat_mode_impute(spark, sf_dir):
    df = _categories(spark, sf_dir)
    values = categories.modes(categories.category_counts(df, COMPLAINTS.one_hot))
    return categories.impute_modes(df, values, MODES).select(KEY, *MODES.values())


@query
def feat_freq_fit(spark, sf_dir):
    return categories.category_counts(_categories(spark, sf_dir), COMPLAINTS.one_hot)


def _frequencies(spark, sf_dir, how: str, **bounds) -> DataFrame:
    """Fitted on the training side, applied to all rows."""
    df = _categories(spark, sf_dir)
    train, _ = sampling.split(df, KEY)
    counts = settle(categories.category_counts(train, COMPLAINTS.one_hot), "frequencies")
    outputs = {c: f"freq_{c}" for c in COMPLAINTS.one_hot}
    return categories.encode_frequency(df, counts, outputs, how=how, **bounds).select(KEY, *outputs.values())


@query
def feat_freq_encode(spark, sf_dir):
    return _frequencies(spark, sf_dir, "left")


@query
def feat_freq_encode_inner(spark, sf_dir):
    return _frequencies(spark, sf_dir, "inner")


@query
def feat_freq_encode_large(spark, sf_dir):
    """All columns together, as when none of the category tables may be broadcast whole."""
    return _frequencies(spark, sf_dir, "left", max_rows=2)


def _indexed(spark, sf_dir) -> DataFrame:
    df = _categories(spark, sf_dir)
    counts = settle(categories.category_counts(df, COMPLAINTS.one_hot), "category-counts")
    labels = settle(categories.index_labels(counts), "labels")
    indexed = categories.encode_index(df, labels, {c: f"si_{c}" for c in COMPLAINTS.one_hot})
    return indexed.select(KEY, *COMPLAINTS.indexed_one_hot)


@query
def feat_string_index(spark, sf_dir):
    return _indexed(spark, sf_dir)


@query
def feat_one_hot(spark, sf_dir):
    """Set positions of the one-hot vectors of all rows; the last label of a column has none.

    Modes fill what is missing first, so that every row has a vector.
    """
    names = list(COMPLAINTS.indexed_one_hot)
    df = settle(_categories(spark, sf_dir), "categories")
    counts = settle(categories.category_counts(df, COMPLAINTS.one_hot), "category-counts")
    values = categories.modes(counts)
    filled = categories.impute_modes(df, values, {c: c for c in COMPLAINTS.one_hot})
    labels = settle(
        categories.index_labels(settle(categories.fold_missing(counts, values), "folded")), "labels"
    )
    indexed = categories.encode_index(filled, labels, {c: f"si_{c}" for c in COMPLAINTS.one_hot})
    indexed = settle(indexed.select(KEY, *(F.col(c).cast("double") for c in names)), "indexed")
    outputs = [f"v_{c}" for c in COMPLAINTS.one_hot]
    encoded = OneHotEncoder(inputCols=names, outputCols=outputs).fit(indexed).transform(indexed)
    arrays = encoded.select(
        KEY, *(stored_entries(v).alias(c) for v, c in zip(outputs, COMPLAINTS.one_hot))
    )
    long = arrays.unpivot([KEY], list(COMPLAINTS.one_hot), "column", "entries")
    return (
        long.select(KEY, "column", F.explode("entries").alias("entry"))
        .where(F.col("entry.value") == 1.0)
        .select(KEY, "column", F.col("entry.position").cast("long").alias("position"))
    )


@query
def feat_tokens(spark, sf_dir):
    words = tokens(F.col("text"))
    return documents(spark, sf_dir).select(
        "doc_id",
        F.size(words).cast("long").alias("n_tokens"),
        F.size(F.filter(words, lambda w: w != "")).cast("long").alias("n_words"),
    )


@query
def feat_term_freq(spark, sf_dir):
    return text.term_frequencies(documents(spark, sf_dir), "doc_id", "text")


@query
def feat_tfidf_terms(spark, sf_dir):
    found = text.tfidf_terms(documents(spark, sf_dir), "doc_id", "text")
    return found.select("doc_id", "term", *rounded("tfidf"))


@query
def feat_hashing_tf(spark, sf_dir):
    return text.hashed_frequencies(documents(spark, sf_dir), "doc_id", "text")


@query
def feat_tfidf_hashed(spark, sf_dir):
    """Hashed TF-IDF vectors in long form."""
    words = documents(spark, sf_dir).select("doc_id", tokens(F.col("text")).alias("words"))
    hashed = HashingTF(inputCol="words", outputCol="tf", numFeatures=40).transform(words)
    weighted = IDF(inputCol="tf", outputCol="tfidf").fit(hashed).transform(hashed)
    return (
        weighted.select("doc_id", F.explode(stored_entries("tfidf")).alias("entry"))
        .select("doc_id", F.col("entry.position").alias("bucket"), F.col("entry.value").alias("tfidf"))
        .where(F.col("tfidf") != 0)
        .select("doc_id", "bucket", *rounded("tfidf"))
    )


def _features(spark, sf_dir):
    """Fitted on the training side of the written table, applied to all of it."""
    needed = (KEY, *COMPLAINTS.required)
    df = settle(complaints(spark, sf_dir, *needed), "accepted")
    train, _ = sampling.split(df, KEY)
    return fit_features(train, COMPLAINTS), df


def _entries(df: DataFrame, vector: str, *keep: str) -> DataFrame:
    """The non-zero entries of a vector column, one to a row."""
    long = df.select(*keep, F.explode(stored_entries(vector)).alias("entry"))
    long = long.select(*keep, "entry.position", "entry.value")
    return long.where(F.col("value") != 0).select(*keep, "position", *rounded("value"))


@query
def feat_assembled(spark, sf_dir):
    model, df = _features(spark, sf_dir)
    return _entries(model.transform(df), COMPLAINTS.assembled, KEY)


@query
def feature_vectors(spark, sf_dir):
    model, df = _features(spark, sf_dir)
    vectors = apply_features(model, df, COMPLAINTS, KEY)
    return _entries(vectors, COMPLAINTS.scaled, KEY, COMPLAINTS.target)


@query
def run_rejected(spark, sf_dir):
    """The columns that a run rejects, read back from where it wrote them."""
    config = _run_config(spark, min_start=date(1900, 1, 1))
    _land(complaints(spark, sf_dir), config.landing)
    ingested = training.ingest(spark, config)
    training.validate_store(spark, config, ingested)
    found = spark.read.parquet(config.output("rejected"))
    return found.select(F.col(KEY).cast("long").alias(KEY), "company_public_response", "error_msg")


@query
def model_reloaded(spark, sf_dir):
    """Vectors of a model that was saved and loaded again."""
    model, df = _features(spark, sf_dir)
    path = new_path(spark, "model")
    model.write().save(path)
    vectors = apply_features(PipelineModel.load(path), df, COMPLAINTS, KEY)
    return _entries(vectors, COMPLAINTS.scaled, KEY, COMPLAINTS.target)


@query
def stage_frequency_encoder(spark, sf_dir):
    """The fitted encoder stage, saved, loaded and applied; as the functions give it."""
    df = _categories(spark, sf_dir)
    train, _ = sampling.split(df, KEY)
    outputs = [f"freq_{c}" for c in COMPLAINTS.one_hot]
    model = stages.FrequencyEncoder(inputCols=list(COMPLAINTS.one_hot), outputCols=outputs).fit(train)
    path = new_path(spark, "encoder")
    model.write().save(path)
    return stages.FrequencyEncoderModel.read().load(path).transform(df).select(KEY, *outputs)


@query
def stage_frequency_imputer(spark, sf_dir):
    df = _categories(spark, sf_dir)
    imputer = stages.FrequencyImputer(inputCols=list(MODES), outputCols=list(MODES.values()))
    return imputer.fit(df).transform(df).select(KEY, *MODES.values())


@query
def run_feature_tables(spark, sf_dir):
    """A whole run, from landed JSON to the written feature tables, counted by side and label."""
    config = _run_config(spark, min_start=date(1900, 1, 1))
    _land(complaints(spark, sf_dir), config.landing)
    out = training.run(spark, config)
    sides = [
        spark.read.parquet(path).select(F.lit(side).alias("side"), COMPLAINTS.target)
        for side, path in (("train", out.train), ("test", out.test))
    ]
    return (
        sampling.union_by_name(sides)
        .groupBy("side", COMPLAINTS.target)
        .agg(F.count(F.lit(1)).alias("n"))
    )


# --- splits, samples and unions --------------------------------------------------------------


@query
def split_train_test(spark, sf_dir):
    side = F.when(sampling.in_train(KEY), "train").otherwise("test")
    return complaints(spark, sf_dir, KEY).select(KEY, side.alias("side"))


@query
def sort_shuffle_rank(spark, sf_dir):
    return sampling.shuffle_rank(complaints(spark, sf_dir, KEY), KEY, salt="s")


@query
def balance_undersample(spark, sf_dir):
    return sampling.balance(complaints(spark, sf_dir, KEY, COMPLAINTS.target), KEY, COMPLAINTS.target)


@query
def set_union(spark, sf_dir):
    """Rows of the two classes, the second with its columns in another order."""
    df = complaints(spark, sf_dir, KEY, "submitted_via", COMPLAINTS.target)
    disputed = df.where(F.col(COMPLAINTS.target) == "Yes")
    settled = df.where(F.col(COMPLAINTS.target) == "No").select(*reversed(df.columns))
    return sampling.union_by_name([disputed, settled])


# --- aggregates and scores -------------------------------------------------------------------


@query
def agg_label_histogram(spark, sf_dir):
    return categories.histogram(complaints(spark, sf_dir, COMPLAINTS.target), COMPLAINTS.target)


@query
def agg_top_category(spark, sf_dir):
    names = ["company_response", "issue"]
    counts = categories.category_counts(complaints(spark, sf_dir, *names), names)
    return categories.most_frequent(counts)


def _matrix(spark, sf_dir) -> DataFrame:
    return evaluate.confusion(table(spark, sf_dir, "labels"), "quality", "toxic")


@query
def eval_confusion(spark, sf_dir):
    return _matrix(spark, sf_dir)


@query
def eval_by_label(spark, sf_dir):
    found = evaluate.scores_by_label(_matrix(spark, sf_dir))
    rates = ("precision", "recall", "false_positive_rate", "f_measure")
    return found.select("class", "actual", "predicted", "tp", *rounded(*rates))


@query
def eval_scores(spark, sf_dir):
    return evaluate.scores(_matrix(spark, sf_dir)).select("metric", *rounded("score"))


# --- streams ---------------------------------------------------------------------------------


@query
def stream_landing_load(spark, sf_dir):
    """Landed events streamed into a table by two runs, the second of which finds nothing new."""
    payload = spark.createDataFrame([], EVENT_PAYLOAD).schema
    landed = stream_landing(spark, _landed_events(spark, sf_dir), payload, whole_files=False)
    target, checkpoint = new_path(spark, "loaded"), new_path(spark, "progress")
    for _ in range(2):
        load_new_files(landed, target, checkpoint)
    return spark.read.schema(payload).parquet(target)


@query
def stream_batch_profile(spark, sf_dir):
    """Missing values per column of a streamed load, summed over its micro-batches."""
    path = new_path(spark, "landing")
    fields = (KEY, "date_received", "company_response", "submitted_via")
    records = complaints(spark, sf_dir, *fields)
    records.select(F.struct(*fields).alias(landing.ENVELOPE)).write.json(path)
    payload = spark.createDataFrame([], ", ".join(f"{c} string" for c in fields)).schema
    root = new_path(spark, "load")
    stream_to_store(
        stream_landing(spark, path, payload),
        f"{root}/progress",
        root=root,
        store=f"{root}/store",
        key=KEY,
        received="date_received",
    )
    totals = spark.read.parquet(f"{root}/profiles").groupBy("column")
    return totals.agg(*(F.sum(c).alias(c) for c in ("total_row", "missing_row")))
