"""Text coercion and the row rules, the same under both ANSI settings."""

import random

import pytest
from pyspark.sql import functions as F

from sift.functions import coerce
from sift.operators import rules

NEGATIVE = [  # text, legacy, exact
    ("-5", True, True),
    ("  -3 ", True, True),
    ("-1.5", True, True),
    ("-0.5", False, True),
    ("-99999999999", None, True),
    ("-1e3", None, True),
    ("5", False, False),
    ("abc", None, None),
    ("", None, None),
    (None, None, None),
]
DATES_OK = [
    "2024-08-10",
    "2024-8-1",
    "2024",
    "2024-08",
    " 2024-08-10 ",
    "2024-08-10 11:22:33",
    "2024-08-10T11:22:33Z",
    "12:30",
    "12:30:00",
    "T12:30",
]
DATES_BAD = [
    "2024/08/10",
    "10-08-2024",
    "2024-02-30",
    "2024-13-01",
    "20240810",
    "today",
    "",
    None,
]
EXACT_DATES_OK = ["2024-08-10", " 2024-08-10 "]


def texts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "c string")


def answers(spark, values, column):
    return [row[0] for row in texts(spark, values).select(column).collect()]


def test_negative(spark, ansi):
    values = [v for v, _, _ in NEGATIVE]
    c = F.col("c")
    assert answers(spark, values, coerce.is_negative(c)) == [x for _, x, _ in NEGATIVE]
    assert answers(spark, values, coerce.is_negative(c, exact=True)) == [x for _, _, x in NEGATIVE]


@pytest.mark.parametrize("exact", [False, True])
def test_negative_rule_rejects_what_is_negative(spark, ansi, exact):
    values = [v for v, _, _ in NEGATIVE]
    schema = texts(spark, []).schema
    rule = rules.negative_rule("c", schema["c"].dataType, exact=exact)
    expected = [bool(row[1 + exact]) for row in NEGATIVE]
    assert answers(spark, values, rule.fails(F.col("c"))) == expected


def test_dates(spark, ansi):
    values = DATES_OK + DATES_BAD
    c = F.col("c")
    expected = [True] * len(DATES_OK) + [False] * len(DATES_BAD)
    assert answers(spark, values, coerce.is_moment(c)) == expected
    got = answers(spark, values, coerce.is_moment(c, exact=True))
    assert got == [v in EXACT_DATES_OK for v in values]


def test_date_rule_does_not_depend_on_the_timestamp_type(spark):
    spark.conf.set("spark.sql.timestampType", "TIMESTAMP_NTZ")
    try:
        assert answers(spark, ["12:30", "2024-08-10T11:22:33Z"], coerce.is_moment(F.col("c"))) == [
            True,
            True,
        ]
    finally:
        spark.conf.unset("spark.sql.timestampType")


@pytest.mark.parametrize(
    "text, type_name, expected",
    [
        ("1.9", "int", "1"),
        (" 7 ", "int", "7"),
        (" 7 ", "decimal(5,2)", "7.00"),
        ("abc", "int", None),
        ("abc", "double", None),
        ("abc", "date", None),
        ("99999999999", "int", None),
        ("99999999999", "bigint", "99999999999"),
        ("99999999999", "decimal(5,2)", None),
        ("12:30", "date", None),
        ("300", "tinyint", None),
        ("-128.9", "tinyint", "-128"),
        ("40000", "smallint", None),
        ("yes", "boolean", "true"),
        (" NO\t", "boolean", "false"),
        ("yess", "boolean", None),
        ("1.5", "string", "1.5"),
        (None, "int", None),
    ],
)
def test_casts(spark, ansi, text, type_name, expected):
    df = texts(spark, [text])
    cast = coerce.lenient_cast(F.col("c"), df.schema["c"].dataType, type_name)
    out = df.select(cast.alias("v"))
    assert out.schema["v"].dataType.simpleString() == type_name
    assert out.select(F.col("v").cast("string")).first()[0] == expected


def random_texts(seed, n=3000):
    rng = random.Random(seed)
    parts = [
        *"0123456789", *"0123456789", "-", "+", ".", " ", "e", "E", ":", "T", "Z", "/", "a",
        "\t", "\n", "\x00", "\x1f", "\x7f", "\x85", "\xa0", "٣", "00", "99999", "2024", "-08",
        "2147483648", "9223372036854775807", "inf", "NaN", "true", "tRUE", "f", "no", "y", "d",
    ]
    return ["".join(rng.choices(parts, k=rng.randint(0, 7))) for _ in range(n)]


TYPES = [
    "tinyint", "smallint", "int", "bigint", "float", "double", "decimal(12,2)", "decimal(5,0)",
    "date", "timestamp", "boolean",
]


@pytest.mark.parametrize("type_name", TYPES)
def test_casts_equal_lenient_spark_casts(spark, type_name):
    """Our expressions with ANSI mode on against Spark's own casts with it off."""
    values = random_texts(seed=TYPES.index(type_name))
    df = texts(spark, values)

    def run(ansi, column):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        return [row[0] for row in df.select(column.cast("string")).collect()]

    before = spark.conf.get("spark.sql.ansi.enabled")
    try:
        theirs = run("false", F.col("c").cast(type_name))
        ours = coerce.lenient_cast(F.col("c"), df.schema["c"].dataType, type_name)
        assert run("true", ours) == theirs
        assert run("false", ours) == theirs
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert any(v is not None for v in theirs)


def test_rules_equal_lenient_spark_rules(spark):
    values = random_texts(seed=99)
    df = texts(spark, values)
    dtype = df.schema["c"].dataType
    before = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.ansi.enabled", "false")
        theirs = df.selectExpr("coalesce(c < 0, false)", "date_format(c, 'yyyy-MM-dd') is null")
        theirs = theirs.collect()
        spark.conf.set("spark.sql.ansi.enabled", "true")
        ours = df.select(
            rules.negative_rule("c", dtype).fails(F.col("c")),
            rules.date_rule("c", dtype).fails(F.col("c")),
        ).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert [tuple(r) for r in ours] == [tuple(r) for r in theirs]
    assert any(r[0] for r in theirs) and any(not r[1] for r in theirs)
