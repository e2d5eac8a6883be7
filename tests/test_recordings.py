import pytest
from conftest import rows
from cohortloom.operators import recordings as rec
from cohortloom.operators import signals
from cohortloom.plans import views


@pytest.fixture(scope="module")
def index(spark):
    data = [
        ("a", 0, 1.0, 0.1, "r0"), ("a", 1, None, 0.2, None), ("a", 3, 7.0, 0.3, "r3"),
        ("a", 7, float("nan"), 0.4, "r7"), ("b", 0, 30.0, 0.5, None), ("c", 2, 5.0, 0.6, "q"),
    ]
    return spark.createDataFrame(
        data, "entity_id string, seq int, hour double, quality double, record_id string"
    )


@pytest.fixture(scope="module")
def samples(spark):
    data = [("a", "r0", "x", 0, 1.0), ("a", "r0", "x", 1, 2.0), ("a", "r3", "y", 0, 3.0),
            ("z", "r0", "x", 0, 9.0)]
    return spark.createDataFrame(
        data, "entity_id string, record_id string, channel string, idx int, value double"
    )


def test_truncation_nests(index):
    eight = rec.truncate_by_hour(index, 8)
    assert {r.record_id for r in eight.collect()} == {"r0", "r3", "q"}
    assert rows(rec.truncate_by_hour(eight, 5)) == rows(rec.truncate_by_hour(index, 5))


def test_latest_and_skip(index):
    assert {r.entity_id: r.record_id for r in rec.latest_recording(index).collect()} == {
        "a": "r7",
        "c": "q",
    }
    # Slots count before the empty ones go: a's first two slots are r0 and the gap.
    kept = rec.skip_first_recordings(index, 2)
    assert sorted(r.record_id for r in kept.collect()) == ["r3", "r7"]
    dense = rec.skip_first_recordings(index, 2, dense_seq=True)
    assert sorted(r.record_id for r in dense.collect()) == ["q", "r3", "r7"]


def test_assembly_keeps_gaps(spark, index, samples):
    text = spark.createDataFrame([(e, f"t{e}") for e in "abcd"], "entity_id string, text string")
    got = rec.assemble_entities(text, index.drop("hour", "quality"), samples)
    assert rows(got.select("entity_id", "seq", "record_id", "n_samples", "text")) == sorted(
        [
            ("a", 0, "r0", 2, "ta"), ("a", 1, None, None, "ta"), ("a", 3, "r3", 1, "ta"),
            ("a", 7, "r7", None, "ta"), ("b", 0, None, None, "tb"), ("c", 2, "q", None, "tc"),
            ("d", None, None, None, "td"),
        ],
        key=repr,
    )
    assert rows(rec.orphan_recordings(index, samples)) == [("a", "r7"), ("c", "q")]


def test_select_channels_marks_missing(samples):
    got = rec.select_channels(samples.where("entity_id = 'a'"), ["y", "x", "w"])
    assert rows(got.select("record_id", "position", "channel", "idx", "value")) == sorted(
        [
            ("r0", 1, "x", 0, 1.0), ("r0", 1, "x", 1, 2.0), ("r0", 0, "y", None, None),
            ("r0", 2, "w", None, None), ("r3", 0, "y", 0, 3.0), ("r3", 1, "x", None, None),
            ("r3", 2, "w", None, None),
        ],
        key=repr,
    )


def test_sampling(spark):
    ids = spark.range(100).select("id").withColumnRenamed("id", "entity_id")
    first = rows(rec.sample_entities(ids, 10, "s"))
    assert first == rows(rec.sample_entities(ids.repartition(7), 10, "s"))
    assert first != rows(rec.sample_entities(ids, 10, "t"))
    with pytest.raises(ValueError):
        rec.sample_entities(ids, 101, "s")
    target, check = rec.split_targets(ids, rec.sample_entities(ids, 10, "s"))
    assert (target.count(), check.count()) == (10, 90)


def test_truncated_samples(spark, index, samples):
    text = spark.createDataFrame([("a", "t")], "entity_id string, text string")
    kept_text, kept_index, kept = rec.truncate_cohort(text, index, samples, 2)
    assert rows(kept) == [("a", "r0", "x", 0, 1.0), ("a", "r0", "x", 1, 2.0)]
    assert (kept_text.count(), kept_index.count()) == (1, 1)


def test_views_do_not_depend_on_the_split(spark, data, monkeypatch):
    plain = rows(views.samples(spark, data))
    real = views.running_total
    monkeypatch.setattr(
        views, "running_total", lambda *a, **k: real(*a, **k, rows_per_task=5)
    )
    assert rows(views.samples(spark, data)) == plain


def test_concat_positions(spark, samples):
    index = spark.createDataFrame(
        [("a", 5, "r0"), ("a", 2, "r3")], "entity_id string, seq int, record_id string"
    )
    more = samples.unionByName(
        spark.createDataFrame([("a", "r3", "x", 0, 7.0)], samples.schema)
    )
    for limit in (1, 100):
        got = signals.concat_recordings(more, index, rows_per_task=limit)
        assert rows(got.where("entity_id = 'a' and channel = 'x'")) == [
            ("a", "x", 0, 7.0), ("a", "x", 1, 1.0), ("a", "x", 2, 2.0),
        ]


def test_missing_values_keep_their_place_in_shingles(spark):
    from cohortloom.operators import signals

    df = spark.createDataFrame(
        [("e", "r", c, i, v) for i, step in enumerate([(1.0, None, 2.0), (1.0, 2.0, None)]) for c, v in zip("abc", step)],
        "entity_id string, record_id string, channel string, idx int, value double",
    )
    assert rows(signals.signal_shingles(df).select("shingle")) == [("1.0,2.0,nan",), ("1.0,nan,2.0",)]


def test_stored_channel_without_header_is_reported(spark):
    from cohortloom.operators import signals

    samples = spark.createDataFrame([("e", "r", c, 0, 5) for c in "ab"], "entity_id string, record_id string, channel string, idx int, raw long")
    spec = spark.createDataFrame(
        [("e", "r", "a", "f", 1, 5, 5)],
        "entity_id string, record_id string, channel string, signal_file string, num_samples long, initial_value long, checksum long",
    )
    report = {r.channel: r for r in signals.signal_quality_report(samples, spec).collect()}
    assert report["a"].shape_ok and report["a"].checksum_ok
    assert report["b"].one_file_ok and not report["b"].shape_ok and not report["b"].checksum_ok
