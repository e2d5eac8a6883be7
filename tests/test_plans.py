"""The physical plans are the intended ones."""

import io
import re
from contextlib import redirect_stdout

import pytest
from cohortloom.operators import hypothesis, recordings, signals, spectral
from cohortloom.operators import similarity as sim
from cohortloom.plans import catalog, views
from pyspark.sql import functions as F


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue()


@pytest.fixture(scope="module")
def index_table(spark, data, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index") / "t")
    views.recording_index(spark, data).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def sample_table(spark, data, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("samples") / "t")
    views.sample_signals(spark, data).write.parquet(path)
    return spark.read.parquet(path)


def test_hour_filter_reaches_the_scan(index_table):
    text = plan(recordings.truncate_by_hour(index_table, 24).select("entity_id"))
    assert "LessThanOrEqual(hour,24" in text
    assert "quality" not in re.search(r"ReadSchema: (.*)", text).group(1)
    assert "Exchange" not in text


def test_skipping_limits_ranks_before_the_shuffle(index_table):
    text = plan(recordings.skip_first_recordings(index_table, 4))
    assert "WindowGroupLimit" in text and "Partial" in text
    dense = plan(recordings.skip_first_recordings(index_table, 4, dense_seq=True))
    assert "GreaterThanOrEqual(seq,4)" in dense and "Exchange" not in dense


def test_statistics_combine_before_the_shuffle(sample_table):
    text = plan(signals.channel_stats(sample_table))
    assert "partial_avg" in text and text.count("Exchange") == 1
    assert "idx" not in re.search(r"ReadSchema: (.*)", text).group(1)


def test_latest_samples_do_not_shuffle_the_samples(sample_table):
    latest = sample_table.select("entity_id", F.lit(1).alias("record_id")).distinct()
    text = plan(spectral.latest_samples(sample_table, latest))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_array_segments_need_no_shuffle(spark, data):
    segments = spectral.segments_from_arrays(views.embedding_signals(spark, data), ["entity_id"], 16)
    assert "Exchange" not in plan(segments)


def test_signatures_combine_before_the_shuffle(spark, data):
    documents = views.table(spark, data, "documents")
    banded = sim.minhash_bands(sim.document_shingles(documents, "doc_id"), 100, 20)
    text = plan(banded)
    assert "partial_min" in text and text.count("Exchange") == 1
    assert re.search(r"ReadSchema: struct<doc_id:bigint,text:string>", text)


def test_candidates_read_only_band_keys(spark, data):
    table = catalog._signatures(spark, data)
    targets = catalog._targets(spark, data)
    text = plan(sim.lsh_candidates(table, targets, catalog.BANDS))
    assert "BroadcastHashJoin" in text and "CartesianProduct" not in text
    assert "NestedLoop" not in text
    assert all("sig:" not in schema for schema in re.findall(r"ReadSchema: (.*)", text))


def test_no_row_level_window_on_one_partition(spark, data):
    pairs = views.value_pairs(spark, data)
    text = plan(hypothesis.signed_ranks(pairs))
    # The one unpartitioned window sees the bucket totals only, at most 8192 rows.
    windows = re.findall(r"Window \[.*?windowspecdefinition\((.*?)ASC", text)
    assert windows
    for spec in windows:
        assert "bucket" in spec


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - {"train_and_evaluate"} - {
    "fit_outcome", "fit_cpc", "score_cohort", "list_entity_folders", "read_entity_text",
    "read_recording_index", "similar_entities_full_size", "truncate_cohort_tables",
}))
def test_no_cross_joins(spark, data, name):
    text = plan(catalog.queries()[name](spark, data))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
