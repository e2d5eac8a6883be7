"""Named queries over the given tables, one or more per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.functions import scoring, text as tx
from cohortloom.operators import features as ft
from cohortloom.operators import exported, failures, hypothesis, metadata, metrics, models, pieces, recordings, signals
from cohortloom.operators import similarity as sim
from cohortloom.operators import spectral
from cohortloom.operators.scale import scratch_path, spread, written_table
from cohortloom.plans import jobs, views
from cohortloom.sources import cohort_files as files

Query = Callable[[SparkSession, str], DataFrame]

NUM_HASHES, BANDS, TARGETS, SEED = 100, 20, 50, "42"
HOUR_LIMIT = 24
CHANNELS = views.EVENT_CHANNELS
TARGET_CHANNELS = ["view", "click", "telemetry", "error"]
SCORE_FIELDS = ["age", "rosc", "ttm", "female", "vfib"]
SCORE_WEIGHTS = [0.03125, -0.0625, 0.125, 0.25, -0.5]
SCORE_BIAS = -4.0
EMPTY_FEATURE = "nothing"

_queries: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _queries[fn.__name__] = fn
    return fn


def queries() -> dict[str, Query]:
    return dict(_queries)


def _rounded(column: str, digits: int = 6):
    return F.round(F.col(column).cast("double"), digits).alias(column)


# Sources


@query
def list_entities(spark, d):
    return recordings.list_entities(views.entity_text(spark, d))


@query
def list_entity_folders(spark, d):
    root = scratch_path(spark, "cohort")
    files.write_entity_text(views.entity_text(spark, d), root)
    return files.list_entities(spark, root)


@query
def read_entity_text(spark, d):
    root = scratch_path(spark, "cohort")
    files.write_entity_text(views.entity_text(spark, d), root)
    return files.read_entity_text(spark, root)


@query
def read_recording_index(spark, d):
    root = scratch_path(spark, "index")
    files.write_recording_index(views.recording_index(spark, d), root)
    read = files.read_recording_index(spark, root)
    return read.select("entity_id", "seq", "hour", "time", _rounded("quality"), "record_id")


@query
def parse_record_headers(spark, d):
    return signals.parse_record_headers(views.record_headers(spark, d))


@query
def assemble_entities(spark, d):
    return recordings.assemble_entities(
        views.entity_text(spark, d), views.recording_index(spark, d), views.order_samples(spark, d)
    )


@query
def entity_recordings(spark, d):
    headers = signals.parse_record_headers(views.record_headers(spark, d))
    found = recordings.entity_recordings(views.gapped_index(spark, d), headers)
    return found.withColumn("channels", F.array_join("channels", ","))


def _cells(samples):
    """Rescaled samples of a chunk as the whole numbers they came from."""
    raw = F.transform(samples, lambda x: F.round(x * views.GAIN + views.OFFSET).cast("long").cast("string"))
    return F.array_join(raw, ",").alias("samples")


@query
def entity_signals(spark, d):
    """Signals of every index slot, in chunks stitched from short pieces."""
    headers = signals.parse_record_headers(views.record_headers(spark, d))
    found = recordings.entity_signals(views.gapped_index(spark, d), headers, views.sample_pieces(spark, d), 32)
    return found.select(*(c for c in found.columns if c != "samples"), _cells("samples"))


@query
def signal_chunks(spark, d):
    """Long samples in chunks."""
    keys = list(signals.SERIES)
    found = pieces.chunks(pieces.pieces_from_samples(views.samples(spark, d), keys, "raw"), keys, 20)
    return found.select(*keys, "chunk", "start", F.array_join(F.col("samples").cast("array<string>"), ",").alias("samples"))


@query
def recording_states(spark, d):
    """States of recordings after two appends: the old samples are not read again."""
    keys = list(signals.SERIES)
    placed = pieces.place_pieces(views.embedding_pieces(spark, d), keys, "number")
    old = pieces.merged_states(pieces.states(placed.where("number % 2 = 0"), keys), keys)
    for rest in ("number % 4 = 1", "number % 4 = 3"):
        old = pieces.merged_states(old.unionByName(pieces.states(placed.where(rest), keys)), keys)
    std = F.sqrt(F.col("m2") / F.col("n"))
    return old.select(*keys, "n", _rounded("mean"), F.round(std, 6).alias("std"), "first_at", _rounded("first"), _rounded("total", 4))


@query
def orphan_recordings(spark, d):
    return recordings.orphan_recordings(
        views.recording_index(spark, d), views.order_samples(spark, d)
    )


@query
def load_labels(spark, d):
    return metadata.load_labels(views.entity_text(spark, d))


@query
def label_object(spark, d):
    """Labels as one object, written in parts and read back; names hold commas and quotes."""
    name = F.concat(F.lit('doc,"'), F.col("entity_id").cast("string"), F.lit('\\"'))
    labels = views.labels(spark, d).select(name.alias("entity_id"), F.col("actual").cast("double").alias("label"))
    path = scratch_path(spark, "label_object")
    files.write_label_object(labels, path)
    return files.read_label_map(spark, path, layout="object")


@query
def read_label_map(spark, d):
    path = scratch_path(spark, "label-map")
    views.label_map(spark, d).write.text(path)
    return files.numeric_labels(spark.read.text(path).toDF("json"), key="id")


# Text and scalar columns


@query
def parse_entity_fields(spark, d):
    return metadata.parse_entity_fields(views.entity_text(spark, d))


@query
def recording_columns(spark, d):
    parsed = files.recording_columns(views.index_texts(spark, d))
    return parsed.select("entity_id", "seq", "hour", "time", _rounded("quality"), "record_id")


def _cast_query(kind: str) -> Query:
    def run(spark, d):
        return views.raw_cells(spark, d).select(
            "cell_id", tx.CASTS[kind](F.col("raw")).alias("value")
        )

    run.__name__ = f"cast_{kind}"
    return query(run)


for _kind in tx.CASTS:
    _cast_query(_kind)


def _classes(raw):
    return [
        f(raw).alias(f.__name__)
        for f in (tx.is_number, tx.is_integer, tx.is_boolean, tx.is_finite_number, tx.is_nan)
    ]


@query
def classify_values(spark, d):
    return views.raw_cells(spark, d).select("cell_id", *_classes(F.col("raw")))


@query
def classify_words(spark, d):
    """Every word of every document, counted per document and class."""
    texts = spread(views.table(spark, d, "documents").select("doc_id", "text"))
    words = texts.select("doc_id", F.explode(F.split("text", " ")).alias("word"))
    flags = words.select("doc_id", *_classes(F.col("word")))
    counts = [F.count_if(c).alias(c) for c in flags.columns if c != "doc_id"]
    return flags.groupBy("doc_id").agg(F.count(F.lit(1)).alias("words"), *counts)


@query
def strip_markup(spark, d):
    return views.raw_cells(spark, d).select(
        "cell_id", tx.strip_markup(F.col("raw")).alias("stripped")
    )


@query
def encode_outcome(spark, d):
    parsed = metadata.parse_entity_fields(views.entity_text(spark, d))
    return parsed.select("entity_id", scoring.encode_outcome(F.col("outcome")).alias("outcome"))


@query
def one_hot_sex(spark, d):
    parsed = metadata.parse_entity_fields(views.entity_text(spark, d))
    return parsed.select("entity_id", *scoring.one_hot_sex(F.col("sex")))


@query
def clip_score(spark, d):
    value = F.col("value") / 20
    return views.table(spark, d, "events").select(
        "event_id", F.round(scoring.clip_score(value), 6).alias("score")
    )


@query
def score_threshold(spark, d):
    events = views.table(spark, d, "events")
    p = scoring.sigmoid((F.col("value") - 50) / 25)
    return events.select(
        "event_id",
        scoring.score_threshold(p).alias("predicted"),
        F.round(p, 6).alias("p"),
        F.round(1 - p, 6).alias("complement"),
    )


# Recordings


@query
def truncate_by_hour(spark, d):
    index = views.recording_index(spark, d).drop("time")
    return recordings.truncate_by_hour(index, HOUR_LIMIT)


@query
def latest_recording(spark, d):
    return recordings.latest_recording(views.recording_index(spark, d))


@query
def skip_first_recordings(spark, d):
    index = views.recording_index(spark, d).select("entity_id", "seq", "record_id")
    return recordings.skip_first_recordings(index, jobs.SKIPPED_RECORDINGS)


@query
def truncate_cohort(spark, d):
    _, _, kept = recordings.truncate_cohort(
        views.entity_text(spark, d),
        views.recording_index(spark, d),
        views.order_samples(spark, d),
        HOUR_LIMIT,
    )
    return kept


@query
def truncate_cohort_tables(spark, d):
    """The whole truncation job, table folder to table folder; returns the kept index."""
    source, target = scratch_path(spark, "cohort"), scratch_path(spark, "truncated")
    files.write_cohort(
        views.entity_text(spark, d),
        views.recording_index(spark, d),
        views.order_samples(spark, d),
        source,
    )
    jobs.truncate(spark, source, target, HOUR_LIMIT)
    _, index, samples = files.read_cohort(spark, target)
    stored = recordings.recording_summary(samples)
    kept = index.join(stored, ["entity_id", "record_id"], "left")
    return kept.select("entity_id", "seq", "record_id", "hour", "n_samples")


@query
def sample_entities(spark, d):
    return recordings.sample_entities(views.document_ids(spark, d), TARGETS, SEED)


@query
def split_targets(spark, d):
    ids = views.document_ids(spark, d)
    chosen = recordings.sample_entities(ids, TARGETS, SEED)
    target, check = recordings.split_targets(ids, chosen)
    return target.withColumn("side", F.lit("target")).unionByName(
        check.withColumn("side", F.lit("check"))
    )


# Signals


@query
def rescale_signal(spark, d):
    spec = signals.parse_record_headers(views.record_headers(spark, d))
    scaled = signals.rescale_signal(views.samples(spark, d), spec)
    return scaled.select(*signals.SERIES, "idx", _rounded("value"))


@query
def rescale_array(spark, d):
    """Embeddings as raw arrays, rescaled in place and read back by position."""
    scaled = views.embedding_signals(spark, d).select(
        "entity_id",
        signals.rescale_array(F.col("samples"), F.lit(0.25), F.lit(1)).alias("samples"),
    )
    long = signals.explode_signal(scaled, out="value")
    return long.select("entity_id", "idx", _rounded("value", 4))


@query
def select_channels(spark, d):
    return recordings.select_channels(views.samples(spark, d), TARGET_CHANNELS, value="raw")


@query
def channel_stats(spark, d):
    stats = signals.channel_stats(views.sample_signals(spark, d))
    return stats.select("entity_id", "channel", "n_samples", _rounded("mean"), _rounded("std"))


@query
def signal_quality_report(spark, d):
    spec = signals.parse_record_headers(views.record_headers(spark, d))
    return signals.signal_quality_report(views.samples(spark, d), spec)


@query
def concat_recordings(spark, d):
    joined = signals.concat_recordings(views.sample_signals(spark, d), views.sample_index(spark, d))
    return joined.select("entity_id", "channel", "position", _rounded("value"))


@query
def signal_shingles(spark, d):
    """Time steps of the recordings after the first one."""
    kept = recordings.skip_first_recordings(views.sample_index(spark, d), 1)
    scaled = views.sample_signals(spark, d)
    used = spectral.latest_samples(scaled, kept)
    return signals.signal_shingles(used.withColumn("value", F.floor("value")))


@query
def signal_signature(spark, d):
    used = views.sample_signals(spark, d).withColumn("value", F.floor("value"))
    return _signature_text(
        sim.minhash_signatures(signals.signal_shingles(used), NUM_HASHES, BANDS)
    )


@query
def welch_psd(spark, d):
    n = views.SAMPLE_N_FFT
    keys = list(signals.SERIES)
    segments = spectral.segments_from_samples(views.sample_signals(spark, d), keys, n)
    psd = spectral.welch_psd(segments, keys, n)
    return psd.select(*keys, "bin", "frequency", _rounded("psd"))


@query
def welch_psd_arrays(spark, d):
    n = views.SAMPLE_N_FFT
    segments = spectral.segments_from_arrays(views.embedding_signals(spark, d), ["entity_id"], n)
    psd = spectral.welch_psd(segments, ["entity_id"], n)
    return psd.select("entity_id", "bin", "frequency", _rounded("psd", 8))


@query
def band_power(spark, d):
    n = views.SAMPLE_N_FFT
    keys = ["entity_id", "channel"]
    latest = recordings.latest_recording(
        views.sample_index(spark, d).selectExpr("*", "0.0D as hour", "0.0D as quality")
    )
    used = spectral.latest_samples(views.sample_signals(spark, d), latest)
    power = spectral.band_power(spectral.segments_from_samples(used, keys, n), keys, n)
    return power.select(*keys, *[_rounded(b) for b in spectral.BANDS])


@query
def band_power_fine(spark, d):
    """Segments of 32 at 64 samples a second: 2 Hz bins, so that every band has bins of its own."""
    signal = views.embedding_signals(spark, d).withColumn("sampling_frequency", F.lit(64.0))
    segments = spectral.segments_from_arrays(signal, ["entity_id"], 32)
    power = spectral.band_power(segments, ["entity_id"], 32)
    return power.select("entity_id", *[_rounded(b, 8) for b in spectral.BANDS])


# Similarity


def _signatures(spark, d):
    return jobs.signature_table(views.shingles(spark, d), NUM_HASHES, BANDS)


def _targets(spark, d):
    return recordings.sample_entities(views.document_ids(spark, d), TARGETS, SEED)


def _signature_text(signatures):
    values = F.transform("sig", lambda v: v.cast("string"))
    return signatures.select("entity_id", F.array_join(values, ",").alias("signature"))


@query
def minhash_signature(spark, d):
    return _signature_text(sim.minhash_signatures(views.shingles(spark, d), NUM_HASHES, BANDS))


@query
def lsh_bands(spark, d):
    signatures = sim.minhash_signatures(views.shingles(spark, d), NUM_HASHES, BANDS)
    return sim.lsh_bands(signatures, NUM_HASHES, BANDS)


@query
def lsh_candidates(spark, d):
    return sim.lsh_candidates(_signatures(spark, d), _targets(spark, d), BANDS)


@query
def signature_jaccard(spark, d):
    both = sim.candidate_similarity(_signatures(spark, d), _targets(spark, d), BANDS)
    return both.select("target_id", "check_id", _rounded("similarity"))


@query
def similar_entities(spark, d):
    found = jobs.find_similar(
        views.shingles(spark, d),
        views.document_ids(spark, d),
        TARGETS,
        NUM_HASHES,
        BANDS,
        seed=SEED,
    )
    return found.select("target_id", "check_id", _rounded("similarity"))


@query
def similar_entities_full_size(spark, d):
    """The job at its default size: 1000 hashes, 50 bands, 5 targets."""
    found = jobs.find_similar(views.shingles(spark, d), views.document_ids(spark, d))
    return found.select("target_id", "check_id", _rounded("similarity"))


@query
def similar_one_per_target(spark, d):
    found = jobs.find_similar(
        views.shingles(spark, d),
        views.document_ids(spark, d),
        TARGETS,
        NUM_HASHES,
        BANDS,
        seed=SEED,
        one_per_target=True,
    )
    return found.select("target_id", "check_id", _rounded("similarity"))


# Labels, metrics and tests


def _label_side(spark, d, column):
    return views.labels(spark, d).select("entity_id", F.col(column).alias("label"))


@query
def pair_labels(spark, d):
    return metrics.pair_labels(
        _label_side(spark, d, "actual"), _label_side(spark, d, "predicted")
    )


@query
def label_map(spark, d):
    labels = metadata.load_labels(views.entity_text(spark, d))
    path = scratch_path(spark, "labels")
    files.write_label_map(labels.select("entity_id", F.col("outcome").alias("label")), path)
    return files.read_label_map(spark, path)


@query
def label_map_scores(spark, d):
    labels = metadata.load_labels(views.entity_text(spark, d))
    path = scratch_path(spark, "scores")
    files.write_label_map(labels.select("entity_id", F.col("cpc").alias("label")), path)
    return files.read_label_map(spark, path)


@query
def classification_metrics(spark, d):
    m = metrics.classification_metrics(views.labels(spark, d))
    return m.select("n", _rounded("accuracy"), _rounded("f1"))


@query
def regression_metrics(spark, d):
    m = metrics.regression_metrics(views.value_pairs(spark, d))
    return m.select("n", _rounded("mse"), _rounded("mae"))


@query
def evaluation_report(spark, d):
    documents = views.table(spark, d, "documents").select("doc_id", "n_chars")
    rows = views.table(spark, d, "labels").join(documents, "doc_id")
    return metrics.evaluation_report(
        rows.select(
            F.col("quality").alias("outcome"),
            F.col("toxic").alias("predicted_outcome"),
            (1 + F.col("n_chars") % 5).alias("cpc"),
            scoring.clip_score((F.col("n_chars") % 70) / 10).alias("predicted_cpc"),
        )
    )


@query
def signed_ranks(spark, d):
    return hypothesis.signed_ranks(views.value_pairs(spark, d))


@query
def permutation_test(spark, d):
    result = hypothesis.permutation_test(views.labels(spark, d), 1000, SEED, "order")
    return result.withColumn("statistic", F.round("statistic", 6))


@query
def permutation_test_close(spark, d):
    """Low-quality flags against toxic flags: close means, so p is not extreme."""
    pairs = views.labels(spark, d).withColumn("actual", 1 - F.col("actual"))
    result = hypothesis.permutation_test(pairs, 1000, SEED, "order")
    return result.withColumn("statistic", F.round("statistic", 6))


@query
def permutation_draws(spark, d):
    """The draws of the job against sorted rows: the same sizes and statistic, p within 0.1.

    The p-values of 1000 permutations each have a standard deviation of 0.016 at most.
    """
    pairs = views.labels(spark, d).withColumn("actual", 1 - F.col("actual"))
    drawn = hypothesis.permutation_test(pairs, 1000, SEED)
    ordered = hypothesis.permutation_test(pairs, 1000, SEED, "order")
    return drawn.unionByName(ordered).groupBy("n_x", "n_y", "n_permutations").agg(
        F.round(F.min("statistic"), 6).alias("statistic"),
        ((F.count(F.lit(1)) == 2) & (F.max("p_value") - F.min("p_value") < 0.1)).alias("p_agrees"),
    )


@query
def wald_test(spark, d):
    result = hypothesis.wald_test(views.value_pairs(spark, d))
    return result.select(_rounded("statistic"), _rounded("p_value"))


@query
def wilcoxon_simple(spark, d):
    result = hypothesis.wilcoxon_simple(views.value_pairs(spark, d))
    return result.select("n", "statistic", _rounded("p_value", 9))


@query
def wilcoxon_normal(spark, d):
    result = hypothesis.wilcoxon_normal(views.value_pairs(spark, d))
    return result.select("n", "statistic", _rounded("z"), _rounded("p_value"))


@query
def test_decisions(spark, d):
    actual, predicted = _label_side(spark, d, "actual"), _label_side(spark, d, "predicted")
    result = jobs.compare_predictions(
        actual, predicted, permutations=1000, seed=SEED, method="order"
    )
    return result.select("test", _rounded("statistic"), _rounded("p_value"), "decision")


test_decisions.__test__ = False


@query
def compare_unpaired(spark, d):
    """Fractional values of two label maps that share part of their entities."""
    events = views.table(spark, d, "events")
    actual = events.where("event_id % 3 <> 0").select(
        F.col("event_id").alias("entity_id"), (F.floor(F.col("value") * 8) / 8).alias("label")
    )
    predicted = events.where("event_id % 3 <> 1").select(
        F.col("event_id").alias("entity_id"),
        (F.floor(F.col("value") * 8) / 8 + (F.col("event_id") % 5 - 2) / 4).alias("label"),
    )
    result = jobs.compare_predictions(
        actual, predicted, permutations=1000, seed=SEED, method="order"
    )
    return result.select("test", _rounded("statistic", 4), _rounded("p_value"), "decision")


# Features and models


def _cohort(spark, d):
    return views.entity_text(spark, d), views.user_index(spark, d), views.user_samples(spark, d)


def _features(spark, d):
    return ft.feature_matrix(*_cohort(spark, d), channels=CHANNELS, n_fft=views.USER_N_FFT)


@query
def feature_matrix(spark, d):
    matrix = _features(spark, d)
    return matrix.select("entity_id", *[_rounded(c) for c in matrix.columns if c != "entity_id"])


@query
def feature_matrix_pieces(spark, d):
    """The features from recordings in array pieces."""
    text, index = views.entity_text(spark, d), views.user_index(spark, d)
    matrix = ft.feature_matrix(text, index, views.user_pieces(spark, d), CHANNELS, views.USER_N_FFT)
    return matrix.select("entity_id", *[_rounded(c) for c in matrix.columns if c != "entity_id"])


@query
def mean_impute(spark, d):
    table = metadata.metadata_features(views.entity_text(spark, d))
    numbers = [F.col(c).cast("double").alias(c) for c in ft.METADATA_FEATURES]
    table = table.select("entity_id", *numbers, F.lit(None).cast("double").alias(EMPTY_FEATURE))
    filled = ft.mean_impute(table, [*ft.METADATA_FEATURES, EMPTY_FEATURE])
    return filled.select("entity_id", *[_rounded(c) for c in filled.columns if c != "entity_id"])


@query
def linear_score(spark, d):
    table = metadata.metadata_features(views.entity_text(spark, d))
    present = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in SCORE_FIELDS]
    logit = scoring.linear_score(present, SCORE_WEIGHTS, SCORE_BIAS)
    p = scoring.sigmoid(logit)
    return table.select(
        "entity_id",
        F.round(p, 6).alias("probability"),
        scoring.score_threshold(p).alias("predicted"),
        F.round(scoring.clip_score(logit), 6).alias("score"),
    )


def _written_features(spark, d):
    return written_table(_features(spark, d), "features")


@query
def fit_outcome(spark, d):
    table, labels = _written_features(spark, d), metadata.load_labels(views.entity_text(spark, d))
    model = models.fit_outcome(table, labels, ft.feature_names(CHANNELS))
    return model.transform(table).select("entity_id", "prediction")


@query
def fit_cpc(spark, d):
    table, labels = _written_features(spark, d), metadata.load_labels(views.entity_text(spark, d))
    model = models.fit_cpc(table, labels, ft.feature_names(CHANNELS))
    return model.transform(table).select("entity_id", "cpc_raw")


@query
def fit_cpc_linear(spark, d):
    """Least squares on one feature without a penalty, for which SQL has the closed form."""
    orders = views.table(spark, d, "orders")
    known = F.col("o_custkey") % 3 > 0
    table = orders.select(
        F.col("o_orderkey").alias("entity_id"),
        (F.col("o_totalprice") / 1000).cast("double").alias("price"),
        F.when(known, 1 + F.col("o_custkey") % 5 + F.col("o_totalprice") / 100000)
        .cast("double")
        .alias("cpc"),
    )
    features, labels = table.select("entity_id", "price"), table.select("entity_id", "cpc")
    model = models.fit_cpc(features, labels, ["price"], "linear", penalty=0.0)
    return model.transform(features).select("entity_id", _rounded("cpc_raw", 4))


@query
def score_properties(spark, d):
    """What holds for any fitted models: keys, failed entities, classes and ranges of scores."""
    scored = score_cohort(spark, d)
    shown = ["predicted_outcome", "poor_probability", "predicted_cpc"]
    filled = sum(F.col(c).isNotNull().cast("int") for c in shown)
    p = F.col("poor_probability")
    inside = p.between(0, 1) & F.col("predicted_cpc").between(1, 5)
    same_class = F.col("predicted_outcome") == (p > 0.5).cast("int")
    return scored.agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("entity_id").alias("n_entities"),
        F.count_if("failed").alias("n_failed"),
        F.count_if(F.col("failed") & (filled > 0)).alias("scored_failed"),
        F.count_if(~F.col("failed") & (filled < 3)).alias("unscored"),
        F.count_if(~F.col("failed") & ~inside).alias("out_of_range"),
        F.count_if(~F.col("failed") & ~same_class).alias("wrong_class"),
    )


@query
def score_cohort(spark, d):
    text, table = views.entity_text(spark, d), _written_features(spark, d)
    fitted = jobs.train(text, table, ft.feature_names(CHANNELS))
    failed = recordings.orphan_recordings(
        views.recording_index(spark, d), views.order_samples(spark, d)
    )
    return models.score_cohort(*fitted, table, failed)


def fixed_models() -> tuple[exported.Exported, exported.Exported]:
    """A network and trees with weights from a rule, for scores that SQL can repeat."""
    n = len(ft.METADATA_FEATURES)
    sizes = [n, 5, 3, 2]
    layers = [
        ([[((7 * k + 3 * j + 5 * i) % 11 - 5) / 8 for i in range(wide)] for j in range(units)],
         [((k + j) % 3 - 1) / 4 for j in range(units)])
        for k, (wide, units) in enumerate(zip(sizes[:-1], sizes[1:]))
    ]
    prepared = [list(ft.METADATA_FEATURES), [40.0 + i for i in range(n)], [30.0 - i for i in range(n)], [2.0 ** -(i % 4 + 2) for i in range(n)]]
    trees = [
        (1.0, [0, 2.5, [4, 1.25, 2.0, 3.5], [1, -6.0, 4.25, 1.5]]),
        (0.5, [4, 0.5, -1.0, [7, 3.0, 0.75, [6, -3.0, 0.5, 1.25]]]),
        (0.25, [2, -3.25, 1.0, 2.0]),
    ]
    return exported.Exported(*prepared, layers=layers), exported.Exported(*prepared, trees=trees)


@query
def score_fixed(spark, d):
    """Network and trees of fixed weights over the cohort, with failed entities."""
    table = metadata.metadata_features(views.entity_text(spark, d))
    failed = recordings.orphan_recordings(views.recording_index(spark, d), views.order_samples(spark, d))
    scored = models.score_cohort(*fixed_models(), table, failed, fill_failed=0.0)
    shown = ("predicted_outcome", "poor_probability", "predicted_cpc")
    return scored.select("entity_id", *(_rounded(c) for c in shown), "failed")


@query
def score_failures(spark, d):
    """Scores of fixed weights for every entity, with the first step in which it failed."""
    text, index = views.gapped_text(spark, d), views.recording_index(spark, d)
    # Line items have no order of their own: the smallest one stands first.
    stored = views.order_samples(spark, d).withColumn("idx", F.col("raw"))
    failed = failures.entity_failures(text, index, stored, views.order_spec(spark, d))
    table = metadata.metadata_features(text)
    scored = failures.score_entities(*fixed_models(), table, failed, fill_failed=0.0)
    shown = ("predicted_outcome", "poor_probability", "predicted_cpc")
    return scored.select("entity_id", *(_rounded(c) for c in shown), "error.step", "error.reason", "error.n")


@query
def train_and_evaluate(spark, d):
    return jobs.train_and_evaluate(
        *_cohort(spark, d), channels=CHANNELS, n_fft=views.USER_N_FFT
    )
