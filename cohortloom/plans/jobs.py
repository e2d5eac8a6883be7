"""Whole jobs from source tables to results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from cohortloom.operators import features as ft
from cohortloom.operators import failures, hypothesis, metadata, metrics, models, recordings, signals
from cohortloom.operators import similarity as sim
from cohortloom.operators import spectral
from cohortloom.operators.scale import written_table
from cohortloom.sources import cohort_files as files

# Defaults of the similarity job.
NUM_HASHES, BANDS, TARGETS, MIN_SIMILARITY = 1000, 50, 5, 0.8
SKIPPED_RECORDINGS = 4


def truncate(spark: SparkSession, source: str, target: str, hour_limit: float) -> None:
    """Write the cohort tables of ``source`` up to the hour to ``target``."""
    files.write_cohort(
        *recordings.truncate_cohort(*files.read_cohort(spark, source), hour_limit), target
    )


def signature_table(shingles: DataFrame, num_hashes: int, bands: int, **options) -> DataFrame:
    """Signatures with band keys, written once: targets and others both read them."""
    signatures = sim.minhash_signatures(shingles, num_hashes, bands, **options)
    return written_table(sim.with_band_keys(signatures, num_hashes, bands), "signatures")


def find_similar(
    shingles: DataFrame,
    entities: DataFrame,
    targets: int = TARGETS,
    num_hashes: int = NUM_HASHES,
    bands: int = BANDS,
    min_similarity: float = MIN_SIMILARITY,
    seed: str = "42",
    include_empty: bool = False,
    **options,
) -> DataFrame:
    """Similar entities of a seeded sample of targets, which is drawn and written once.

    With ``include_empty``, entities without shingles take part and equal each other.
    """
    chosen = written_table(recordings.sample_entities(entities, targets, seed), "targets")
    every = {"entities": entities} if include_empty else {}
    signatures = signature_table(shingles, num_hashes, bands, **every)
    return sim.similar_entities(signatures, chosen, bands, min_similarity, **options)


def find_similar_signals(
    index: DataFrame,
    samples: DataFrame,
    skip: int = SKIPPED_RECORDINGS,
    round_to: int | None = None,
    **options,
) -> DataFrame:
    """The same on signals: time steps after the first recordings are the shingles."""
    kept = recordings.skip_first_recordings(index, skip).select("entity_id", "record_id")
    used = spectral.latest_samples(samples, kept)
    shingles = signals.signal_shingles(used, round_to=round_to)
    return find_similar(shingles, index.select("entity_id"), **options)


def train(
    entity_text: DataFrame,
    features: DataFrame,
    names: Sequence[str],
    kinds: tuple[str, str] = ("network", "trees"),
    save_to: str | None = None,
) -> tuple[PipelineModel, PipelineModel]:
    """Outcome and score model fitted on one feature table, saved below ``save_to`` if given.

    A fit is a chain of short jobs, so both run at once: the tasks of one fill the gaps of the other.
    """
    labels = metadata.load_labels(entity_text)

    def fit(step, kind: str) -> PipelineModel:
        return step(features, labels, names, kind)

    with ThreadPoolExecutor(2) as pool:
        run = inheritable_thread_target(features.sparkSession)(fit)
        fitted = tuple(pool.map(run, (models.fit_outcome, models.fit_cpc), kinds))
    if save_to:
        for name, model in zip(("outcome", "cpc"), fitted):
            model.write().save(f"{save_to.rstrip('/')}/{name}")
    return fitted


def train_and_evaluate(
    entity_text: DataFrame,
    index: DataFrame,
    samples: DataFrame,
    channels: Sequence[str] = ft.CHANNELS,
    n_fft: int = spectral.DEFAULT_N_FFT,
    bands: Mapping[str, tuple[float, float]] = spectral.BANDS,
    holdout: float = 0.2,
    kinds: tuple[str, str] = ("network", "trees"),
) -> DataFrame:
    """Metric report on the training entities and on a held-out share.

    Features are computed once and written; both models and the scoring read them.
    """
    table = ft.feature_matrix(entity_text, index, samples, channels, n_fft, bands)
    features = written_table(table, "features")
    training, held_out = models.hash_split(features, holdout)
    fitted = train(entity_text, training, ft.feature_names(channels, bands), kinds)
    labels = metadata.load_labels(entity_text)
    reports = []
    for part, rows in (("training", training), ("held_out", held_out)):
        scored = models.score_cohort(*fitted, rows).join(labels, "entity_id")
        report = metrics.evaluation_report(scored)
        reports.append(report.select(F.lit(part).alias("part"), "*"))
    return reports[0].unionByName(reports[1])


def score(
    entity_text: DataFrame,
    index: DataFrame,
    samples: DataFrame,
    fitted: tuple[PipelineModel, PipelineModel],
    spec: DataFrame | None = None,
    fill_failed: float | None = 0.0,
    observation: Observation | None = None,
    **options,
) -> DataFrame:
    """Scores of every entity that has a text or a recording, failures of any step included.

    ``samples`` are long with raw and rescaled values; ``options`` go to the feature table.
    """
    failed = failures.entity_failures(entity_text, index, samples, spec)
    table = ft.feature_matrix(entity_text, index, samples, **options)
    return failures.score_entities(*fitted, table, failed, fill_failed, observation)


def compare_predictions(actual: DataFrame, predicted: DataFrame, **options) -> DataFrame:
    """All tests on two label maps (entity_id, label), paired by entity.

    Entities that only one map has count in the tests on unpaired samples.
    """
    pairs = written_table(metrics.pair_labels(actual, predicted, "full"), "pairs")
    return hypothesis.test_decisions(pairs, **options)
