import hashlib

import pytest
from conftest import rows
from cohortloom.functions import hashing
from cohortloom.operators import similarity as sim
from cohortloom.plans import jobs, views
from pyspark.sql import functions as F

HASHES, BANDS = 60, 12


def brute_signature(words):
    def digits(text, a, b):
        return int(hashlib.md5(text.encode()).hexdigest()[a:b], 16)

    out = []
    for i in range(HASHES):
        a, b, c = 1 + digits(f"a{i}", 0, 7), digits(f"b{i}", 0, 7), 1 + digits(f"c{i}", 0, 7)
        out.append(min((a * digits(w, 0, 7) + c * digits(w, 7, 14) + b) % (2**31 - 1) for w in words))
    return out


SETS = {
    1: [f"w{i}" for i in range(40)],
    2: [f"w{i}" for i in range(40)],
    3: [f"w{i}" for i in range(1, 41)],
    4: [f"v{i}" for i in range(30)],
    5: ["é", "ß", "w1"],
}


@pytest.fixture(scope="module")
def shingles(spark):
    data = [(k, w) for k, ws in SETS.items() for w in ws + ws[:3]] + [(6, None)]
    return spark.createDataFrame(data, "entity_id long, shingle string")


def test_signatures_match_brute_force(shingles, monkeypatch):
    for chunk, parts in ((sim.CHUNK, 1), (5, 3), (1, 8)):
        monkeypatch.setattr(sim, "CHUNK", chunk)
        got = sim.minhash_signatures(shingles.repartition(parts), HASHES, BANDS).collect()
        assert {r.entity_id: list(r.sig) for r in got} == {
            k: brute_signature(ws) for k, ws in SETS.items()
        }


def test_empty_entities_on_request(spark, shingles):
    ids = spark.range(1, 9).withColumnRenamed("id", "entity_id")
    got = sim.minhash_signatures(shingles, HASHES, BANDS, entities=ids).collect()
    by_id = {r.entity_id: list(r.sig) for r in got}
    assert by_id[6] == by_id[7] == by_id[8] == [hashing.NO_SHINGLE] * HASHES
    assert by_id[1] == brute_signature(SETS[1])


def test_bands_must_divide(shingles):
    with pytest.raises(ValueError):
        sim.minhash_signatures(shingles, 60, 7)


def table(shingles):
    signatures = sim.minhash_signatures(shingles, HASHES, BANDS)
    return sim.with_band_keys(signatures, HASHES, BANDS).cache()


def test_pairs_match_brute_force(spark, shingles, monkeypatch):
    signatures = table(shingles)
    targets = spark.createDataFrame([(1,), (5,)], "entity_id long")
    sigs = {k: brute_signature(ws) for k, ws in SETS.items()}
    r = HASHES // BANDS
    expected = set()
    for t in (1, 5):
        for c in (2, 3, 4):
            same_band = any(
                sigs[t][i * r : i * r + r] == sigs[c][i * r : i * r + r] for i in range(BANDS)
            )
            x, y = set(sigs[t]), set(sigs[c])
            if same_band and len(x & y) / len(x | y) > 0.5:
                expected.add((t, c))
    assert (1, 2) in expected and (1, 3) in expected
    for limit in (sim.BROADCAST_BYTES, 0):
        monkeypatch.setattr(sim, "BROADCAST_BYTES", limit)
        found = sim.similar_entities(signatures, targets, BANDS, min_similarity=0.5)
        assert {(p.target_id, p.check_id) for p in found.collect()} == expected
    best = sim.similar_entities(signatures, targets, BANDS, 0.5, one_per_target=True)
    assert [(p.target_id, p.check_id, p.similarity) for p in best.collect()] == [(1, 2, 1.0)]


def test_jaccard_properties(spark):
    df = spark.createDataFrame(
        [([1, 2, 2, 3], [3, 4]), ([], []), ([5], [5, 5])], "x array<int>, y array<int>"
    )
    both = df.select(
        sim.value_set_jaccard(F.col("x"), F.col("y")), sim.value_set_jaccard(F.col("y"), F.col("x"))
    )
    assert [tuple(r) for r in both.collect()] == [(0.25, 0.25), (None, None), (1.0, 1.0)]


def test_recall_on_documents(spark, data):
    """Every pair of a target whose exact word-set Jaccard is above 0.9 is a candidate."""
    shingles = views.shingles(spark, data)
    signatures = jobs.signature_table(shingles, 100, 20)
    targets = views.document_ids(spark, data).where("entity_id < 100")
    found = {tuple(r) for r in sim.lsh_candidates(signatures, targets, 20).collect()}
    words = {}
    for k, w in shingles.distinct().collect():
        words.setdefault(k, set()).add(w)
    exact = {
        (t, c)
        for t in words if t < 100
        for c in words if c >= 100
        if len(words[t] & words[c]) / len(words[t] | words[c]) > 0.9
    }
    assert exact and exact <= found


def test_signal_job(spark):
    index = spark.createDataFrame(
        [(e, s, f"r{s}") for e in ("a", "b", "c") for s in range(3)],
        "entity_id string, seq int, record_id string",
    )
    samples = spark.createDataFrame(
        [
            (e, f"r{s}", ch, i, float(i + (100 if e == "c" else 0) + (50 * s if e == "a" and s == 0 else 0)))
            for e in ("a", "b", "c") for s in range(3) for ch in ("x", "y") for i in range(30)
        ],
        "entity_id string, record_id string, channel string, idx int, value double",
    )
    found = jobs.find_similar_signals(
        index, samples, skip=1, targets=1, num_hashes=20, bands=10, seed="0"
    )
    pairs = {frozenset((r.target_id, r.check_id)) for r in found.collect()}
    # a and b differ in the skipped recording only; c shares no time step with either.
    assert pairs <= {frozenset(("a", "b"))}
    every = jobs.find_similar_signals(
        index.where("entity_id <> 'c'"), samples, skip=1, targets=1, num_hashes=20, bands=10
    )
    assert {frozenset((r.target_id, r.check_id)) for r in every.collect()} == {frozenset("ab")}
