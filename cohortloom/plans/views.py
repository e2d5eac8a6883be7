"""Cohort-shaped views over the given tables: customers, orders and events as entities.

Every view keeps all rows of its table. Positions within a group come from
``running_total``, so a customer or event type with very many rows is split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.operators.scale import running_total, spread
from cohortloom.operators.similarity import document_shingles

GAIN, OFFSET = 50.0, 10
# Notional sampling rates and segment lengths: event series are short.
SAMPLE_FS, SAMPLE_N_FFT = 64.0, 16
USER_FS, USER_N_FFT = 32.0, 4
EVENT_CHANNELS = ("click", "error", "purchase", "signup", "view")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def entity_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as ``Key: value`` texts, with gaps and NaN words."""
    key = "lpad(cast(c_custkey as string), 6, '0')"
    text = f"""
      concat('Patient: ', {key}, '\\n',
        'Age: ', if(c_custkey % 17 = 0, 'nan', cast(c_custkey % 90 as string)), '\\n',
        'Sex: ', case c_nationkey % 4 when 0 then 'Female' when 1 then 'Male'
                 when 2 then 'Other' else 'nan' end, '\\n',
        'ROSC: ', if(c_custkey % 5 = 0, 'nan', cast(c_custkey % 60 as string)), '\\n',
        'OHCA: ', case c_custkey % 3 when 0 then 'True' when 1 then 'False' else 'nan' end, '\\n',
        'VFib: ', if(c_custkey % 2 = 0, 'True', 'False'), '\\n',
        if(c_custkey % 4 = 0, '', concat('TTM: ', cast(33 + 3 * (c_custkey % 2) as string), '\\n')),
        'Outcome: ', if(c_acctbal < 0, 'Poor', 'Good'), '\\n',
        'CPC: ', cast(1 + c_custkey % 5 as string))"""
    return table(spark, sf_dir, "customer").selectExpr(f"{key} as entity_id", f"{text} as text")


def recording_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as recordings of their customer, in date order."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    placed = running_total(
        orders, F.lit(1), "seq", keys=["o_custkey"], order=["o_orderdate", "o_orderkey"]
    )
    return placed.selectExpr(
        "lpad(cast(o_custkey as string), 6, '0') as entity_id",
        "cast(seq as int) as seq",
        "if(o_orderkey % 19 = 0, null, cast(6 * seq + o_orderkey % 6 as double)) as hour",
        "concat(lpad(cast(o_orderkey % 24 as string), 2, '0'), ':00:00') as time",
        "cast(o_orderkey % 100 as double) / 100 as quality",
        "if(o_orderkey % 7 = 0, null, cast(o_orderkey as string)) as record_id",
    )


def index_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as an index file of one row, one cell of it sometimes empty."""
    return table(spark, sf_dir, "orders").selectExpr(
        "cast(o_orderkey as string) as entity_id",
        """concat('Hour\\tTime\\tQuality\\tRecord\\n', '\\n',
             if(o_orderkey % 19 = 0, '', cast(o_orderkey % 72 as string)), '\\t', '12:30', '\\t',
             cast(o_orderkey % 100 as string), 'e-2\\t',
             if(o_orderkey % 7 = 0, 'nan', cast(o_custkey as string)), '\\n') as text""",
    )


def order_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as the signal of their order."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice"
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).selectExpr(
        "lpad(cast(o_custkey as string), 6, '0') as entity_id",
        "cast(o_orderkey as string) as record_id",
        "concat('L', cast(l_linenumber as string)) as channel",
        "cast(round(l_extendedprice * 100) as bigint) as raw",
    )


def gapped_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``entity_text`` where some entities' texts could not be read."""
    lost = F.col("entity_id").cast("bigint") % 13 == 0
    return entity_text(spark, sf_dir).withColumn("text", F.when(~lost, F.col("text")))


def order_spec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What headers claim about ``order_samples``; some checksums are wrong."""
    series = ["entity_id", "record_id", "channel"]
    wrong = (F.col("record_id").cast("bigint") % 41 == 0).cast("int")
    return order_samples(spark, sf_dir).groupBy(*series).agg(
        F.max("record_id").alias("signal_file"),
        F.count(F.lit(1)).alias("num_samples"),
        F.min("raw").alias("initial_value"),
        (F.sum("raw") + F.max(wrong)).alias("checksum"),
    )


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as samples of ten entities with three recordings each."""
    raw = table(spark, sf_dir, "events").selectExpr(
        "cast(user_id % 10 as int) as entity_id",
        "cast(day(ts) % 3 as int) as record_id",
        "event_type as channel",
        "cast(round(value * 100) as bigint) as raw",
        "ts",
        "event_id",
    )
    keys = ["entity_id", "record_id", "channel"]
    placed = running_total(raw, F.lit(1), "idx", keys=keys, order=["ts", "event_id"])
    return placed.select(*keys, F.col("idx").cast("int").alias("idx"), "raw")


def as_pieces(long: DataFrame, keys: list[str], value: str, length: int) -> DataFrame:
    """Long samples as a table of array pieces, some of them short, of ``length`` samples at most."""
    number = F.floor((F.col("idx") + F.pmod(F.xxhash64(*keys), F.lit(length))) / length)
    grouped = long.groupBy(*keys, number.alias("piece")).agg(
        F.min("idx").cast("long").alias("start"), F.array_sort(F.collect_list(F.struct("idx", value))).alias("held")
    )
    return grouped.select(*keys, "start", F.col(f"held.{value}").alias("samples"))


def sample_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``samples`` as array pieces of up to seven raw values."""
    return as_pieces(samples(spark, sf_dir), ["entity_id", "record_id", "channel"], "raw", 7)


def gapped_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``sample_index`` with an empty last slot for every entity."""
    index = sample_index(spark, sf_dir).select("entity_id", "seq", "record_id")
    gaps = index.select("entity_id").distinct().selectExpr("entity_id", "9 as seq", "cast(null as int) as record_id")
    return index.unionByName(gaps)


def user_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``user_samples`` as array pieces of up to three values."""
    keys = ["entity_id", "record_id", "channel", "sampling_frequency"]
    return as_pieces(user_samples(spark, sf_dir), keys, "value", 3)


def embedding_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embedding vectors as numbered pieces of the recordings of their label."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("label").alias("entity_id"),
        (F.col("vec_id") % 3).cast("int").alias("record_id"),
        F.lit("vector").alias("channel"),
        F.col("vec_id").alias("number"),
        F.col("embedding").alias("samples"),
    )


def sample_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The recordings of ``samples`` in order."""
    return (
        table(spark, sf_dir, "events")
        .selectExpr("cast(user_id % 10 as int) as entity_id", "cast(day(ts) % 3 as int) as record_id")
        .distinct()
        .withColumn("seq", F.col("record_id"))
    )


def channel_spec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What headers claim about ``samples``; every kind of claim is sometimes wrong."""
    entity, channel = F.col("entity_id"), F.col("channel")
    wrong_sum = ((entity % 5 == 0) & (channel == "error")).cast("int")
    wrong_first = ((entity % 4 == 1) & (channel == "view")).cast("int")
    other_file = (entity % 3 == 2) & (F.col("record_id") == 1) & (channel == "click")
    return (
        samples(spark, sf_dir)
        .groupBy("entity_id", "record_id", "channel")
        .agg(
            F.count(F.lit(1)).cast("int").alias("num_samples"),
            F.min_by("raw", "idx").alias("first"),
            F.sum("raw").alias("total"),
        )
        .select(
            "entity_id",
            "record_id",
            "channel",
            F.concat_ws(
                "_", "entity_id", "record_id", F.when(other_file, F.lit("b"))
            ).alias("signal_file"),
            F.lit(GAIN).alias("gain"),
            F.lit(OFFSET).alias("adc_offset"),
            "num_samples",
            (F.col("first") + wrong_first).alias("initial_value"),
            (F.col("total") + wrong_sum).alias("checksum"),
        )
    )


def record_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header texts; a recording has few channels, so its lines fit one row."""
    line = F.concat_ws(
        " ",
        F.concat("signal_file", F.lit(".mat")),
        F.lit("16 50/uV 16"),
        "adc_offset",
        "initial_value",
        "checksum",
        F.lit("0"),
        "channel",
    )
    spec = channel_spec(spark, sf_dir)
    grouped = spec.groupBy("entity_id", "record_id").agg(
        F.array_sort(F.collect_list(F.struct("channel", line.alias("line")))).alias("lines"),
        F.max("num_samples").alias("longest"),
    )
    first = F.concat_ws(
        " ",
        F.concat_ws("_", "entity_id", "record_id"),
        F.size("lines"),
        F.lit("64"),
        "longest",
    )
    text = F.concat_ws("\n", first, F.lit(" "), F.array_join("lines.line", "\n"))
    return grouped.select("entity_id", "record_id", text.alias("text"))


def scaled_value(raw: str = "raw"):
    return ((F.col(raw) - OFFSET) / GAIN).cast("float")


def sample_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``samples`` rescaled, with a sampling frequency."""
    return samples(spark, sf_dir).select(
        "entity_id",
        "record_id",
        "channel",
        "idx",
        scaled_value().alias("value"),
        F.lit(SAMPLE_FS).alias("sampling_frequency"),
    )


def user_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as samples of their user, one recording per 15 days; users are customers."""
    raw = table(spark, sf_dir, "events").selectExpr(
        "lpad(cast(user_id as string), 6, '0') as entity_id",
        "concat(lpad(cast(user_id as string), 6, '0'), '_', "
        "cast((day(ts) - 1) div 15 as string)) as record_id",
        "event_type as channel",
        "cast(round(value * 100) as bigint) as raw",
        "ts",
        "event_id",
    )
    keys = ["entity_id", "record_id", "channel"]
    placed = running_total(raw, F.lit(1), "idx", keys=keys, order=["ts", "event_id"])
    return placed.select(
        *keys,
        "idx",
        scaled_value().alias("value"),
        F.lit(USER_FS).alias("sampling_frequency"),
    )


def user_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The recordings of ``user_samples`` and one empty last slot per user."""
    events = table(spark, sf_dir, "events").selectExpr(
        "lpad(cast(user_id as string), 6, '0') as entity_id",
        "cast((day(ts) - 1) div 15 as int) as seq",
        "cast(round(value * 100) as bigint) as raw",
    )
    slots = events.groupBy("entity_id", "seq").agg(F.sum("raw").alias("total"))
    stored = slots.select(
        "entity_id",
        "seq",
        (F.col("seq") * 360.0).alias("hour"),
        ((F.col("total") % 100) / 100).alias("quality"),
        F.concat_ws("_", "entity_id", "seq").alias("record_id"),
    )
    gaps = events.select("entity_id").distinct().selectExpr(
        "entity_id", "9 as seq", "cast(null as double) as hour", "0.0D as quality",
        "cast(null as string) as record_id",
    )
    return stored.unionByName(gaps)


def raw_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a text cell in one of many spellings of numbers and flags."""
    n = "cast(o_custkey as string)"
    spellings = [
        n, f"concat(' ', {n}, '\\t')", f"concat({n}, '.0')", f"concat({n}, '.5')",
        f"concat('1_', {n})", f"concat({n}, 'd')", f"concat({n}, 'f')", f"concat('0x', {n})",
        "'inf'", "'-inf'", "'Infinity'", "'nan'", "'NaN'", "'+nan'", "'True'", "'t'", "'F'",
        "'false'", "'yes'", f"concat('\"', {n}, '\"')", "'[1]'", "'\\'0\\''",
        f"concat({n}, ' 0')", "''", f"concat({n}, 'e3')", "concat('_', '1')", "'1__0'",
    ]
    cases = " ".join(f"when {i} then {s}" for i, s in enumerate(spellings))
    raw = f"case o_orderkey % {len(spellings)} {cases} end"
    return table(spark, sf_dir, "orders").selectExpr("o_orderkey as cell_id", f"{raw} as raw")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").selectExpr(
        "doc_id as entity_id", "quality as actual", "toxic as predicted"
    )


def label_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels as JSON members; some are null, strings, booleans or NaN."""
    return labels(spark, sf_dir).selectExpr(
        """concat('{"id": "', cast(entity_id as string), '", "value": ',
             case when entity_id % 11 = 0 then 'null' when entity_id % 13 = 0 then '"7"'
                  when entity_id % 17 = 0 then 'true' when entity_id % 19 = 0 then 'NaN'
                  else cast(actual as string) end, '}') as json"""
    )


def value_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as pairs of whole numbers."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id as entity_id",
        "cast(floor(value) as bigint) % 50 as actual",
        "cast(regexp_extract(props, '[0-9]+', 0) as bigint) % 50 as predicted",
    )


def shingles(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return document_shingles(spread(documents), "doc_id")


def document_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").selectExpr("doc_id as entity_id")


def embedding_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embedding vectors as array signals."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("entity_id"),
        F.lit(SAMPLE_FS).alias("sampling_frequency"),
        F.col("embedding").alias("samples"),
    )
