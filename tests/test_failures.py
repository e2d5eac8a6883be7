import pytest
from pyspark.sql import Observation

from cohortloom.operators import exported, failures

MODELS = (
    exported.Exported(["a", "b"], [1.0, 0.0], [0.0, 0.0], [1.0, 1.0], linear=([1.0, 0.0], 0.0), link=True),
    exported.Exported(["a", "b"], [1.0, 0.0], [0.0, 0.0], [1.0, 1.0], linear=([1.0, 0.0], 2.0)),
)


@pytest.fixture()
def cohort(spark):
    text = spark.createDataFrame(
        [("good", "Age: 1"), ("blank", None), ("lost", "Age: 1"), ("differs", "Age: 1"), ("idle", "Age: 2"), (None, "x")],
        "entity_id string, text string",
    )
    index = spark.createDataFrame(
        [("good", 0, "g"), ("blank", 0, "gone"), ("lost", 0, "l0"), ("lost", 1, "l1"), ("lost", 2, "l0"),
         ("differs", 0, "d"), ("unheard", 0, "u"), ("idle", 0, None), (None, 0, "z")],
        "entity_id string, seq int, record_id string",
    )
    stored = [(e, r, "c", i, v) for e, r in (("good", "g"), ("differs", "d"), ("unheard", "u"), ("good", "spare"))
              for i, v in enumerate((5, 7))]
    samples = spark.createDataFrame(stored, "entity_id string, record_id string, channel string, idx int, raw long")
    # The spare recording is wrong, but no index names it.
    claims = [("good", "g", 12), ("differs", "d", 13), ("unheard", "u", 12), ("good", "spare", 99)]
    spec = spark.createDataFrame(
        [(e, r, "c", r, 2, 5, total) for e, r, total in claims],
        "entity_id string, record_id string, channel string, signal_file string, num_samples int, initial_value long, checksum long",
    )
    return text, index, samples, spec


def told(df):
    return {r.entity_id: tuple(r.error) if r.error else None for r in df.collect()}


def test_first_failing_step_of_every_entity(cohort):
    text, index, samples, spec = cohort
    wanted = {
        "blank": ("text", "no text", 1),
        "unheard": ("text", "no text", 1),
        "lost": ("recordings", "recording not stored", 2),
    }
    assert told(failures.entity_failures(text, index, samples)) == wanted
    wanted["differs"] = ("signals", "header and samples differ", 1)
    assert told(failures.entity_failures(text, index, samples, spec)) == wanted
    none = [t.limit(0) for t in cohort]
    assert failures.entity_failures(*none).collect() == []


def test_scores_cover_every_entity(spark, cohort):
    features = spark.createDataFrame(
        [("good", 0.5, 1.0), ("blank", None, 1.0), ("lost", 1.0, 1.0), ("differs", 1.0, 1.0), ("idle", None, None),
         ("endless", 1.0, float("inf"))],
        "entity_id string, a double, b double",
    )
    seen = Observation("failures")
    found = failures.entity_failures(*cohort)
    rows = {r.entity_id: r for r in failures.score_entities(*MODELS, features, found, 0.0, seen).collect()}
    assert set(rows) == {"good", "blank", "unheard", "lost", "differs", "idle", "endless"}
    failed = {k: r.error.step for k, r in rows.items() if r.error}
    assert failed == {
        "blank": "text", "unheard": "text", "lost": "recordings", "differs": "signals", "endless": "scores",
    }
    assert all(tuple(rows[k])[1:4] == (0.0, 0.0, 0.0) for k in failed)
    assert rows["good"].predicted_cpc == 2.5 and rows["idle"].predicted_cpc == 3.0
    assert seen.get == {"entities": 7, "text": 2, "recordings": 1, "signals": 1, "scores": 1}
    nulls = failures.score_entities(*MODELS, features, found).where("error is not null").collect()
    assert {tuple(r)[1:4] for r in nulls} == {(None, None, None)}
