"""Operators on the recording index: entity_id, seq, hour, quality, record_id."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.operators import pieces
from cohortloom.operators.scale import maybe_broadcast, skew_join



def list_entities(table: DataFrame) -> DataFrame:
    return table.select("entity_id").distinct().orderBy("entity_id")


def truncate_by_hour(index: DataFrame, hour_limit: float) -> DataFrame:
    """Rows up to and including the hour; a missing hour does not pass."""
    hour = F.col("hour")
    return index.where((hour <= hour_limit) & ~F.isnan(hour))


def latest_recording(index: DataFrame) -> DataFrame:
    """Last row per entity that names a recording, by one partial aggregate."""
    row = F.struct("seq", "record_id", "hour", "quality")
    return (
        index.where(F.col("record_id").isNotNull())
        .groupBy("entity_id")
        .agg(F.max_by(row, F.col("seq")).alias("r"))
        .select("entity_id", "r.seq", "r.record_id", "r.hour", "r.quality")
    )


def skip_first_recordings(index: DataFrame, n: int, dense_seq: bool = False) -> DataFrame:
    """Drop each entity's first ``n`` slots, then the slots without a recording.

    Slots count before missing recordings are removed. ``dense_seq`` states that seq
    runs 0, 1, 2, ... per entity and turns the operator into a plain filter.
    """
    named = F.col("record_id").isNotNull()
    if dense_seq:
        return index.where((F.col("seq") >= n) & named)
    # The rank limit is applied per map task before the shuffle, so a hot entity
    # sends at most n rows per task.
    rank = F.row_number().over(Window.partitionBy("entity_id").orderBy("seq"))
    first = index.select("entity_id", "seq", rank.alias("slot")).where(F.col("slot") <= n)
    last_skipped = first.groupBy("entity_id").agg(F.max("seq").alias("last_skipped"))
    kept = skew_join(index, last_skipped, ["entity_id"])
    return kept.where((F.col("seq") > F.col("last_skipped")) & named).drop("last_skipped")


def sample_entities(entities: DataFrame, count: int, seed: str, strict: bool = True) -> DataFrame:
    """``count`` entity ids chosen by a seeded hash; a distributed top-k, no full sort.

    ``strict`` raises when there are fewer entities than asked for.
    """
    ids = entities.select("entity_id").distinct()
    if strict and ids.count() < count:
        raise ValueError(f"asked for {count} entities, there are fewer")
    position = F.md5(F.concat(F.lit(seed), F.col("entity_id").cast("string")))
    return ids.orderBy(position, "entity_id").limit(count)


def split_targets(table: DataFrame, targets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of the targets, rows of everyone else)."""
    ids = maybe_broadcast(targets.select("entity_id"))
    return table.join(ids, "entity_id", "left_semi"), table.join(ids, "entity_id", "left_anti")


def recording_summary(samples: DataFrame) -> DataFrame:
    """Per recording: how many channels and samples are stored."""
    per_channel = samples.groupBy("entity_id", "record_id", "channel").agg(
        F.count(F.lit(1)).alias("n")
    )
    return per_channel.groupBy("entity_id", "record_id").agg(
        F.count(F.lit(1)).alias("n_channels"), F.sum("n").alias("n_samples")
    )


def assemble_entities(entity_text: DataFrame, index: DataFrame, samples: DataFrame) -> DataFrame:
    """Text, index slot and stored signal of every entity, gaps kept as NULL.

    An index slot without a recording stays as a placeholder, and an entity without
    any slot stays as a single row. Slots without a recording and entities without a slot
    skip the joins, so their NULL keys never meet in one task.
    """
    stored = recording_summary(samples)
    named = F.col("record_id").isNotNull()
    empty = [F.lit(None).cast("long").alias(c) for c in ("n_channels", "n_samples")]
    slots = (
        index.where(named)
        .join(stored, ["entity_id", "record_id"], "left")
        .unionByName(index.where(~named).select("*", *empty))
        .select("entity_id", "seq", "record_id", "n_channels", "n_samples")
    )
    with_slots = slots.join(entity_text, "entity_id")
    without = entity_text.join(index.select("entity_id").distinct(), "entity_id", "left_anti")
    return with_slots.unionByName(without, allowMissingColumns=True)


def entity_recordings(index: DataFrame, headers: DataFrame) -> DataFrame:
    """Every index slot with what its recording's header says, gaps kept as NULL.

    entity_id, seq, record_id, sampling_frequency, channels (in header order) and num_samples;
    ``headers`` has a row for each channel line. A slot without a recording, or whose recording
    has no header, is a placeholder.
    """
    keys = ["entity_id", "record_id"]
    # A header names few channels, so its list is small.
    heads = headers.groupBy(*keys).agg(
        F.max("sampling_frequency").alias("sampling_frequency"),
        F.array_sort(F.collect_list(F.struct("position", "channel"))).alias("lines"),
        F.max("num_samples").alias("num_samples"),
    )
    named = F.col("record_id").isNotNull()
    slots = index.where(named).select(*keys, "seq").join(heads, keys, "left")
    # Placeholders skip the join, so that their NULL keys never meet in one task.
    rows = slots.unionByName(index.where(~named).select(*keys, "seq"), allowMissingColumns=True)
    return rows.select(
        "entity_id", "seq", "record_id", "sampling_frequency", F.col("lines.channel").alias("channels"), "num_samples"
    )


def entity_signals(
    index: DataFrame, headers: DataFrame, signals: DataFrame, size: int = pieces.CHUNK
) -> DataFrame:
    """The rescaled samples of every index slot, in chunks of ``size``.

    entity_id, seq, record_id, channel, position (of the channel in its header), chunk, start
    and samples. ``signals`` are array pieces of raw samples (entity_id, record_id, channel, start,
    samples). A recording that several slots name comes with each of them. No row is larger
    than a chunk, however long a recording is; header lines come to the samples, which stay
    where they are but for the ends of pieces.
    """
    keys = ["entity_id", "record_id"]
    named = index.where(F.col("record_id").isNotNull()).select(*keys, "seq")
    lines = headers.select(*keys, "channel", "position", "gain", "adc_offset")
    slots = named.join(lines, keys).groupBy(*keys, "channel", "position", "gain", "adc_offset").agg(
        F.array_sort(F.collect_set("seq")).alias("seqs")
    )
    series = [*keys, "channel"]
    raw = pieces.chunks(signals.select(*series, "start", "samples"), series, size)
    value = F.transform("samples", lambda x: ((x - F.col("adc_offset")) / F.col("gain")).cast("float"))
    placed = skew_join(raw, slots, series)
    return placed.select(
        "entity_id", F.explode("seqs").alias("seq"), "record_id", "channel", "position", "chunk", "start",
        value.alias("samples"),
    )


def orphan_recordings(index: DataFrame, samples: DataFrame) -> DataFrame:
    """Recordings the index names but no signal is stored for."""
    stored = samples.select("entity_id", "record_id").distinct()
    named = index.where(F.col("record_id").isNotNull()).select("entity_id", "record_id")
    return named.join(stored, ["entity_id", "record_id"], "left_anti").distinct()


def truncate_cohort(
    entity_text: DataFrame, index: DataFrame, samples: DataFrame, hour_limit: float
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Text unchanged, index up to the hour, and the samples the kept slots name."""
    kept = truncate_by_hour(index, hour_limit)
    keys = ["entity_id", "record_id"]
    named = kept.where(F.col("record_id").isNotNull()).select(*keys).distinct()
    # Adaptive execution broadcasts a small side and splits hot recordings, without counting.
    return entity_text, kept, samples.join(named, keys, "left_semi")


def select_channels(
    samples: DataFrame, targets: list[str], value: str = "value"
) -> DataFrame:
    """Samples of the target channels with their position in the target list.

    Other channels are dropped. A target a recording lacks gives one row whose
    idx and value are NULL.
    """
    keys = ["entity_id", "record_id"]
    names = F.array(*[F.lit(t) for t in targets])
    position = (F.array_position(names, F.col("channel")) - 1).cast("int").alias("position")
    present = samples.where(F.col("channel").isin(*targets)).select(
        *keys, position, "channel", "idx", value
    )
    # Channels per recording are few, so the collected set is small.
    seen = samples.groupBy(*keys, "channel").count().groupBy(*keys).agg(
        F.collect_set("channel").alias("seen")
    )
    absent = seen.select(*keys, F.explode(F.array_except(names, "seen")).alias("channel"))
    schema = samples.schema
    missing = absent.select(
        *keys,
        position,
        "channel",
        F.lit(None).cast(schema["idx"].dataType).alias("idx"),
        F.lit(None).cast(schema[value].dataType).alias(value),
    )
    return present.unionByName(missing)


