"""Signal operators on long samples: entity_id, record_id, channel, idx, raw or value.

Arrays of samples enter through ``explode_signal``, which needs no shuffle; every
aggregate here combines on the map side, so one long recording does not weigh on
one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions import text as tx
from cohortloom.operators.scale import ROWS_PER_TASK, running_total, skew_join

SERIES = ("entity_id", "record_id", "channel")


def _integer(c: Column) -> Column:
    return tx.parse_number(c).cast("long")


def parse_record_headers(headers: DataFrame) -> DataFrame:
    """One row per channel line of header texts (entity_id, record_id, text).

    Parsed inside the row: the record line is line 0, blank lines do not count, and the
    gain is the text before the slash. Unreadable numbers are NULL.
    """
    lines = F.filter(F.transform(F.split("text", "\n"), tx.strip), lambda x: x != "")
    record = F.transform(F.split(F.get("lines", F.lit(0)), " "), tx.strip)
    rows = (
        headers.select("entity_id", "record_id", lines.alias("lines"))
        .select(
            "entity_id",
            "record_id",
            record.alias("r"),
            F.posexplode(F.expr("slice(lines, 2, size(lines))")).alias("position", "line"),
        )
        .withColumn("c", F.split("line", " "))
    )

    def part(array: str, i: int) -> Column:
        return F.get(F.col(array), F.lit(i))

    return rows.select(
        "entity_id",
        "record_id",
        part("r", 0).alias("record_name"),
        _integer(part("r", 1)).alias("num_signals"),
        tx.parse_number(part("r", 2)).alias("sampling_frequency"),
        _integer(part("r", 3)).alias("num_samples"),
        "position",
        part("c", 0).alias("signal_file"),
        tx.parse_number(F.get(F.split(part("c", 2), "/"), F.lit(0))).alias("gain"),
        _integer(part("c", 4)).alias("adc_offset"),
        _integer(part("c", 5)).alias("initial_value"),
        _integer(part("c", 6)).alias("checksum"),
        part("c", 8).alias("channel"),
    )


def explode_signal(signals: DataFrame, samples: str = "samples", out: str = "raw") -> DataFrame:
    """Array signals to one row per sample, in place."""
    others = [c for c in signals.columns if c != samples]
    return signals.select(*others, F.posexplode(samples).alias("idx", out))


def rescale_signal(samples: DataFrame, spec: DataFrame) -> DataFrame:
    """value = (raw - offset) / gain in single precision.

    ``spec`` holds one row per channel of a recording.
    """
    factors = spec.select(*SERIES, "gain", "adc_offset")
    joined = skew_join(samples, factors, SERIES)
    value = ((F.col("raw") - F.col("adc_offset")) / F.col("gain")).cast("float")
    return joined.select(*SERIES, "idx", value.alias("value"))


def rescale_array(samples: Column, gain: Column, offset: Column) -> Column:
    """The same rescaling for a row that carries its samples as an array."""
    return F.transform(samples, lambda x: ((x - offset) / gain).cast("float"))


def channel_stats(samples: DataFrame) -> DataFrame:
    """Mean and population deviation per channel over all recordings of an entity."""
    value = F.col("value").cast("double")
    present = samples.where(value.isNotNull() & ~F.isnan(value))
    return present.groupBy("entity_id", "channel").agg(
        F.count(F.lit(1)).alias("n_samples"),
        F.avg(value).alias("mean"),
        F.stddev_pop(value).alias("std"),
    )


def signal_quality_report(samples: DataFrame, spec: DataFrame) -> DataFrame:
    """Header claims against stored samples, one row per channel of the header or the store.

    A channel that only one of the two has fails all checks of its stored values.
    """
    stored = samples.groupBy(*SERIES).agg(
        F.count(F.lit(1)).alias("stored_samples"),
        F.min_by("raw", "idx").alias("stored_first"),
        F.sum("raw").alias("stored_sum"),
    )
    files = spec.groupBy("entity_id", "record_id").agg(
        F.countDistinct("signal_file").alias("n_files")
    )
    report = spec.join(stored, list(SERIES), "full").join(
        files, ["entity_id", "record_id"], "left"
    )

    def agrees(stored_column: str, claimed: str) -> Column:
        return F.coalesce(F.col(stored_column) == F.col(claimed), F.lit(False))

    return report.select(
        *SERIES,
        F.coalesce(F.col("n_files") == 1, F.lit(False)).alias("one_file_ok"),
        agrees("stored_samples", "num_samples").alias("shape_ok"),
        agrees("stored_first", "initial_value").alias("initial_ok"),
        agrees("stored_sum", "checksum").alias("checksum_ok"),
    )


def concat_recordings(
    samples: DataFrame, index: DataFrame, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Position of every sample in its entity's joined recording, channel by channel.

    Recordings follow each other in index order. The result stays one row per
    sample; only recording lengths take part in the running total.
    """
    keys = ["entity_id", "record_id"]
    slots = index.where(F.col("record_id").isNotNull()).select(*keys, "seq")
    lengths = samples.groupBy(*SERIES).agg(F.count(F.lit(1)).alias("n"))
    starts = running_total(
        lengths.join(slots, keys),
        F.col("n"),
        "start",
        keys=["entity_id", "channel"],
        order=["seq"],
        rows_per_task=rows_per_task,
    )
    # Adaptive execution splits the pieces of a hot series; no count of the samples is needed.
    placed = samples.join(starts.select(*SERIES, "start"), list(SERIES))
    return placed.select(
        "entity_id", "channel", (F.col("start") + F.col("idx")).alias("position"), "value"
    )


def signal_shingles(
    samples: DataFrame, channels: list[str] | None = None, round_to: int | None = None
) -> DataFrame:
    """One shingle per time step: the values of all channels, in channel order.

    A missing value keeps its place, as ``nan``. A group holds one value per channel, so it is as small as the channel count.
    """
    if channels is not None:
        samples = samples.where(F.col("channel").isin(*channels))
    value = F.col("value").cast("double")
    if round_to is not None:
        value = F.round(value, round_to)
    step = samples.groupBy("entity_id", "record_id", "idx").agg(
        F.array_sort(F.collect_list(F.struct(F.col("channel"), value.alias("v")))).alias("s")
    )
    return step.select(
        "entity_id",
        F.array_join(F.transform("s.v", lambda v: v.cast("string")), ",", "nan").alias("shingle"),
    )
