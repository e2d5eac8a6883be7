"""Similar entities: MinHash signatures, banding and signature comparison."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.functions.hashing import (
    NO_SHINGLE,
    coefficients,
    fingerprint,
    run_minima,
    split_fingerprints,
)
from cohortloom.operators.recordings import split_targets
from cohortloom.operators.scale import skew_join

# Shingles hashed at a time: one hash vector of this length stays in the CPU cache.
CHUNK = 32_768
# Target signatures sent to every executor may take this many bytes.
BROADCAST_BYTES = 64 * 2**20


def document_shingles(documents: DataFrame, id_column: str, text: str = "text") -> DataFrame:
    """Distinct lower-case words of whole texts, found inside the row."""
    words = F.explode(F.array_distinct(F.split(F.lower(F.col(text)), " "))).alias("shingle")
    return documents.select(F.col(id_column).alias("entity_id"), words).where("shingle <> ''")


def _check_bands(num_hashes: int, bands: int) -> int:
    if bands < 1 or num_hashes % bands:
        raise ValueError(f"{bands} bands do not divide {num_hashes} hashes")
    return num_hashes // bands


def minhash_bands(shingles: DataFrame, num_hashes: int, bands: int) -> DataFrame:
    """Signature in banded form: entity_id, band, v0..v{rows-1}.

    Python sees each shingle once, in any partitioning, and emits minima per chunk;
    the JVM finishes with one map-side-combined minimum. Nothing is grouped by entity
    before that, so an entity holding most shingles is hashed by many tasks.
    """
    rows = _check_bands(num_hashes, bands)
    id_type = shingles.schema["entity_id"].dataType
    values = [f"v{j}" for j in range(rows)]
    schema = T.StructType(
        [T.StructField("entity_id", id_type), T.StructField("band", T.IntegerType())]
        + [T.StructField(v, T.IntegerType()) for v in values]
    )
    family = coefficients(num_hashes)

    def partial(ids: pa.Array, md5: pa.Array) -> pa.RecordBatch:
        entity = ids.dictionary_encode()
        codes = entity.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        fixed = md5.cast(pa.binary(16))
        raw = np.frombuffer(fixed.buffers()[1], dtype=np.uint8)
        raw = raw[16 * fixed.offset : 16 * (fixed.offset + len(fixed))]
        prints = split_fingerprints(raw)
        order = np.lexsort((prints, codes))
        codes, prints = codes[order], prints[order]
        fresh = np.ones(len(codes), dtype=bool)
        fresh[1:] = (codes[1:] != codes[:-1]) | (prints[1:] != prints[:-1])
        codes, prints = codes[fresh], prints[fresh]
        starts = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
        minima = run_minima(prints, starts, family).reshape(-1, rows)
        ids_out = entity.dictionary.take(pa.array(np.repeat(codes[starts], bands)))
        band = np.tile(np.arange(bands, dtype=np.int32), len(starts))
        columns = [ids_out, pa.array(band)]
        columns += [pa.array(np.ascontiguousarray(minima[:, j])) for j in range(rows)]
        return pa.RecordBatch.from_arrays(columns, names=["entity_id", "band", *values])

    def partials(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            return partial(table["entity_id"].chunk(0), table["md5"].chunk(0))

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(b.num_rows for b in held) >= CHUNK:
                yield flush()
        if held:
            yield flush()

    present = shingles.where(F.col("entity_id").isNotNull() & F.col("shingle").isNotNull())
    prints = present.select("entity_id", fingerprint(F.col("shingle")).alias("md5"))
    smallest = [F.min(v).alias(v) for v in values]
    return prints.mapInArrow(partials, schema).groupBy("entity_id", "band").agg(*smallest)


def minhash_signatures(
    shingles: DataFrame, num_hashes: int, bands: int, entities: DataFrame | None = None
) -> DataFrame:
    """entity_id, sig ARRAY<INT>.

    Entities without shingles have no row. Given ``entities``, they get a signature
    of NO_SHINGLE values, so that all empty entities equal each other.
    """
    banded = minhash_bands(shingles, num_hashes, bands)
    values = F.array(*[c for c in banded.columns if c.startswith("v")])
    parts = F.array_sort(F.collect_list(F.struct("band", values.alias("v"))))
    found = banded.groupBy("entity_id").agg(parts.alias("parts"))
    signatures = found.select("entity_id", F.flatten("parts.v").alias("sig"))
    if entities is None:
        return signatures
    nothing = F.array_repeat(F.lit(NO_SHINGLE), num_hashes)
    every = entities.select("entity_id").distinct().join(signatures, "entity_id", "left")
    return every.select("entity_id", F.coalesce("sig", nothing).alias("sig"))


def band_slices(signature: Column, bands: int, rows: int) -> Column:
    """The signature cut into its bands: ARRAY<ARRAY<INT>>."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(bands - 1)), lambda i: F.slice(signature, i * rows + 1, rows)
    )


def lsh_bands(signatures: DataFrame, num_hashes: int, bands: int) -> DataFrame:
    """entity_id, band, band_key: the md5 of the band's values joined by commas."""
    rows = _check_bands(num_hashes, bands)
    cut = F.posexplode(band_slices(F.col("sig"), bands, rows)).alias("band", "vals")
    key = F.md5(F.array_join(F.transform("vals", lambda v: v.cast("string")), ","))
    return signatures.select("entity_id", cut).select("entity_id", "band", key.alias("band_key"))


def with_band_keys(signatures: DataFrame, num_hashes: int, bands: int) -> DataFrame:
    """Add band_keys ARRAY<BIGINT>, the only column the candidate search reads."""
    rows = _check_bands(num_hashes, bands)
    keys = F.transform(band_slices(F.col("sig"), bands, rows), lambda v: F.xxhash64(v))
    return signatures.withColumn("band_keys", keys)


def _side(table: DataFrame, side: str) -> DataFrame:
    return table.select(
        F.col("entity_id").alias(f"{side}_id"),
        F.col("sig").alias(f"{side}_sig"),
        F.col("band_keys").alias(f"{side}_keys"),
    )


def _fits_broadcast(target: DataFrame) -> bool:
    """Whether all target signatures and band keys stay below the broadcast limit."""
    first = target.select(F.size("target_sig"), F.size("target_keys")).head()
    row_bytes = 4 * first[0] + 32 * first[1] if first else 1
    limit = BROADCAST_BYTES // row_bytes
    return target.select("target_id").limit(limit + 1).count() <= limit


def candidate_pairs(signatures: DataFrame, targets: DataFrame, bands: int) -> DataFrame:
    """Pairs of a target and another entity that share a band, with both signatures.

    A pair is emitted at its first common band only, so no distinct is needed and a
    bucket of copies costs one row per pair. A target set of a checked size is
    broadcast: the other entities are scanned once and never move. A larger one is an
    equi-join of narrow band rows, with the signatures looked up afterwards.
    """
    target_rows, check_rows = split_targets(signatures, targets)
    target, check = _side(target_rows, "target"), _side(check_rows, "check")
    equal = F.zip_with("check_keys", "target_keys", lambda x, y: x == y)
    # Copies agree in band 0 already, which spares them the search for the first band.
    first_equal = F.get("check_keys", F.lit(0)) == F.get("target_keys", F.lit(0))
    at_first_band = (
        F.when(F.col("band") == 0, F.lit(True))
        .when(first_equal, F.lit(False))
        .otherwise(F.col("band") == F.array_position(equal, F.lit(True)) - 1)
    )
    pair = ["target_id", "check_id", "target_sig", "check_sig"]
    cut = {s: F.posexplode(f"{s}_keys").alias("band", "band_key") for s in ("target", "check")}
    on_band = ["band", "band_key"]
    if _fits_broadcast(target):
        by_band = F.broadcast(target.select("target_id", cut["target"]))
        found = check.select("*", cut["check"]).join(by_band, on_band)
        return found.join(F.broadcast(target), "target_id").where(at_first_band).select(*pair)
    narrow_target = target.select("target_id", "target_keys", cut["target"])
    narrow_check = check.select("check_id", "check_keys", cut["check"])
    ids = narrow_check.join(narrow_target, on_band).where(at_first_band)
    found = ids.select("target_id", "check_id").join(check.drop("check_keys"), "check_id")
    # One target may have most of the pairs, so its key is split.
    target_sig = target.drop("target_keys")
    return skew_join(found, target_sig, ["target_id"], broadcast_rows=0, count_on=ids).select(*pair)


def lsh_candidates(signatures: DataFrame, targets: DataFrame, bands: int) -> DataFrame:
    """Distinct (target_id, check_id) sharing a band; only band keys are read."""
    return candidate_pairs(signatures, targets, bands).select("target_id", "check_id")


def value_set_jaccard(x: Column, y: Column) -> Column:
    """Jaccard similarity of the two arrays' value sets; NULL when both are empty."""
    common = F.size(F.array_intersect(x, y)).cast("double")
    jaccard = F.try_divide(common, F.size(F.array_union(x, y)).cast("double"))
    # Copies are frequent among candidates and need no sets.
    return F.when((x == y) & (F.size(x) > 0), F.lit(1.0)).otherwise(jaccard)


def position_match(x: Column, y: Column) -> Column:
    """Share of positions holding equal values: the usual estimate from signatures."""
    equal = F.filter(F.zip_with(x, y, lambda a, b: a == b), lambda e: e)
    return F.try_divide(F.size(equal).cast("double"), F.size(x).cast("double"))


ESTIMATES = {"value_set": value_set_jaccard, "position": position_match}


def candidate_similarity(
    signatures: DataFrame, targets: DataFrame, bands: int, estimate: str = "value_set"
) -> DataFrame:
    """(target_id, check_id, similarity) of every candidate pair."""
    pairs = candidate_pairs(signatures, targets, bands)
    score = ESTIMATES[estimate](F.col("target_sig"), F.col("check_sig"))
    return pairs.select("target_id", "check_id", score.alias("similarity"))


def similar_entities(
    signatures: DataFrame,
    targets: DataFrame,
    bands: int,
    min_similarity: float = 0.8,
    estimate: str = "value_set",
    one_per_target: bool = False,
) -> DataFrame:
    """Pairs of a target and another entity whose similarity lies above the cut.

    All qualifying candidates are kept; ``one_per_target`` keeps the best of each.
    ``signatures`` needs band_keys and should be a written table: it is read twice.
    """
    scored = candidate_similarity(signatures, targets, bands, estimate)
    similar = scored.where(F.col("similarity") > min_similarity)
    if not one_per_target:
        return similar
    best = Window.partitionBy("target_id").orderBy(F.desc("similarity"), "check_id")
    return similar.withColumn("place", F.row_number().over(best)).where("place <= 1").drop("place")
