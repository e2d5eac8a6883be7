"""Entity text to typed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.functions import scoring, text as tx

# Output column, key in the text and type of every known field.
ENTITY_FIELDS = (
    ("patient", "Patient", "string"),
    ("age", "Age", "int"),
    ("sex", "Sex", "string"),
    ("rosc", "ROSC", "int"),
    ("ohca", "OHCA", "bool"),
    ("vfib", "VFib", "bool"),
    ("ttm", "TTM", "int"),
    ("outcome", "Outcome", "string"),
    ("outcome_probability", "Outcome probability", "float"),
    ("cpc", "CPC", "float"),
)


def parse_entity_fields(entity_text: DataFrame, prefix_match: bool = False) -> DataFrame:
    """All fields in one narrow projection; absent or junk values are NULL."""
    columns = [
        tx.field(F.col("text"), key, kind, prefix_match).alias(out)
        for out, key, kind in ENTITY_FIELDS
    ]
    return entity_text.select("entity_id", *columns)


def load_labels(entity_text: DataFrame, strict: bool = False) -> DataFrame:
    """entity_id, patient, outcome (0 or 1) and cpc; ``strict`` raises on a gap."""
    parsed = parse_entity_fields(entity_text)
    cpc = F.col("cpc")
    if strict:
        problem = F.concat(F.lit("no usable score: "), F.col("entity_id"))
        cpc = F.when(cpc.isNotNull(), cpc).otherwise(F.raise_error(problem).cast("double"))
    return parsed.select(
        "entity_id",
        "patient",
        scoring.encode_outcome(F.col("outcome"), strict).alias("outcome"),
        cpc.alias("cpc"),
    )


def label_problems(entity_text: DataFrame) -> DataFrame:
    """Entities whose outcome or score is missing or not understood."""
    parsed = parse_entity_fields(entity_text)
    bad = scoring.encode_outcome(F.col("outcome")).isNull() | F.col("cpc").isNull()
    return parsed.where(bad).select("entity_id", "outcome", "cpc")


def metadata_features(entity_text: DataFrame) -> DataFrame:
    """The eight entity values of the feature vector."""
    parsed = parse_entity_fields(entity_text)
    return parsed.select(
        "entity_id", "age", *scoring.one_hot_sex(F.col("sex")), "rosc", "ohca", "vfib", "ttm"
    )
