import math

from cohortloom.functions import scoring, text as tx
from cohortloom.operators import metadata
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

JUNK = [
    "1", " 1 ", "1.0", "1.5", "1_000", "1d", "1f", "0x1", "inf", "-inf", "Infinity", "nan", "NaN",
    "+nan", "-nan", "True", "t", "F", "false", "yes", '"1"', "[1]", "'0'", "1 0", "", "1e3", "1_", "_1",
    "1__0", "1._5", ".5", "5.", ".", "+", "-.5e-3", "1e", "1e1_0", " 1　", "\x1c2\x85", "1\n",
    "+inf", "infinit", "-INFINITY", "0.0", "-0", "1e400", "00012", " 7", "e5", "+-1", "[nan]",
]


def number(x):
    try:
        return float(x)
    except ValueError:
        return None


def unmarked(x):
    for c in "\"'[] ":
        x = x.replace(c, "")
    return x.strip()


def expected(x):
    n, m = number(x), number(unmarked(x))
    finite = n is not None and math.isfinite(n)
    real = None if m is None or math.isnan(m) else m
    flag = None
    if m == 0 or unmarked(x) in tx.FALSE_WORDS:
        flag = 0
    elif m == 1 or unmarked(x) in tx.TRUE_WORDS:
        flag = 1
    return {
        "is_number": n is not None,
        "is_nan": n is not None and math.isnan(n),
        "is_finite_number": finite,
        "is_integer": finite and n.is_integer(),
        "is_boolean": n in (0, 1) or unmarked(x) in tx.FALSE_WORDS + tx.TRUE_WORDS,
        "cast_float": real,
        "cast_int": real if real is not None and math.isfinite(real) and real.is_integer() else None,
        "cast_bool": flag,
        "strip": x.strip(),
    }


def check(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "raw string")
    names = list(expected("1"))
    got = df.select("raw", *[getattr(tx, n)(F.col("raw")).alias(n) for n in names]).collect()
    for row in got:
        assert {n: row[n] for n in names} == expected(row["raw"]), repr(row["raw"])


def test_casts_follow_python(spark):
    check(spark, JUNK)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.text(alphabet="0123456789+-._eEinfatyNdx \t\n\"'[]", max_size=8), min_size=300, max_size=300
    )
)
def test_casts_follow_python_on_random_text(spark, values):
    check(spark, values)


def test_null_is_no_number(spark):
    df = spark.createDataFrame([(None,)], "raw string")
    row = df.select(tx.is_number(F.col("raw")), tx.is_nan(F.col("raw")), tx.cast_int(F.col("raw")))
    assert tuple(row.head()) == (False, False, None)


def test_field_rules(spark):
    text = "Age: 5\nTime: 12:30\nOutcome probability: 0.75\nOutcome: Poor\nAge: 9\nSex:\nCPC : 2"
    df = spark.createDataFrame([("e", text)], "entity_id string, text string")

    def value(name, kind="string", **options):
        return df.select(tx.field(F.col("text"), name, kind, **options)).head()[0]

    assert value("Age", "int") == 5.0  # the first line wins
    assert value("Time") == "12"  # up to the second colon
    assert value("Outcome") == "Poor"
    assert value("Outcome", prefix_match=True) == "0.75"  # any line that starts so
    assert value("Sex") == ""
    assert value("ROSC", "int") is None
    parsed = metadata.parse_entity_fields(df).head()
    assert (parsed.outcome_probability, parsed.cpc) == (0.75, 2.0)


def test_labels_report_and_raise(spark):
    df = spark.createDataFrame(
        [("a", "Patient: a\nOutcome: Good\nCPC: 1"), ("b", "Patient: b\nOutcome: Odd\nCPC: nan")],
        "entity_id string, text string",
    )
    got = {r.entity_id: (r.outcome, r.cpc) for r in metadata.load_labels(df).collect()}
    assert got == {"a": (0, 1.0), "b": (None, None)}
    assert [r.entity_id for r in metadata.label_problems(df).collect()] == ["b"]
    try:
        metadata.load_labels(df, strict=True).collect()
    except Exception as error:
        assert "no usable" in str(error)
    else:
        raise AssertionError("strict labels did not raise")


def test_scores(spark):
    df = spark.createDataFrame([(0.2,), (7.0,), (3.0,), (None,)], "x double")
    got = df.select(
        scoring.clip_score(F.col("x")), scoring.score_threshold(F.col("x") / 6)
    ).collect()
    assert [tuple(r) for r in got] == [(1.0, 0), (5.0, 1), (3.0, 0), (None, None)]
