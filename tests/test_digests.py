import hashlib

import numpy as np
from cohortloom.functions import digests
from cohortloom.operators import hypothesis as hy
from test_hypothesis import brute_permutation


def test_many_digests_at_once():
    for messages in ([b""], [b"x" * i for i in range(49)], [b"y" * i for i in range(40, 70)], [b"%d" % i for i in range(40_000)]):
        prefixes = [f"7|{k}|".encode() for k in range(7, 12)]
        seen = []
        for part, words in digests.salted_md5(messages, prefixes):
            wanted = [[hashlib.md5(p + m) for m in messages] for p in prefixes[part]]
            assert [[int(h.hexdigest()[:15], 16) for h in row] for row in wanted] == digests.leading(words).tolist()
            at = np.nonzero(np.ones(words[0].shape, dtype=bool))
            assert digests.digest_bytes(words, at) == [h.digest() for row in wanted for h in row]
            seen += prefixes[part]
        assert seen == prefixes


def test_ordered_permutations_hash_by_arrays(spark):
    # Ids of any length, one of them missing; values wider than a double's whole numbers when added.
    data = [("i" * (i % 80) + str(i), i * 7 % 10 * 2.0**40, ((i * 3 + 1) % 10 + (i % 9 == 0)) * 2.0**40) for i in range(400)]
    df = spark.createDataFrame(data, "entity_id string, actual double, predicted double")
    got = hy.permutation_test(df.repartition(6), 120, "s" * 9, "order")
    assert "md5" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert got.head().n_above == brute_permutation(data, 120, "s" * 9)
    assert tuple(hy.permutation_test(df.coalesce(1), 120, "s" * 9, "order").head()) == tuple(got.head())
