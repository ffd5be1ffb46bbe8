import random

from pyspark.sql import functions as F

from tradewind.functions.dates import MIXED_DATE_LAYOUTS, dashed_not_iso, lenient_date, mixed_date, months_apart
from tradewind.functions.numbers import grouped_number, plain_number, ratio, round_to
from tradewind.functions.text import canonical, normalize_code, strip, within_domain


def column(spark, values, kind, expr):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(expr(F.col("v"))).collect()]


def test_strip_takes_every_kind_of_space(spark):
    given = [" de ", "\tfr\n", "  gb ", "", None]
    assert column(spark, given, "string", strip) == ["de", "fr", "gb", "", None]
    assert column(spark, given, "string", normalize_code) == ["DE", "FR", "GB", "", None]


def test_unknown_and_null_codes_take_the_default(spark):
    got = column(spark, ["DE", "XX", None], "string", lambda c: within_domain(c, ["DE"], "UNK"))
    assert got == ["DE", "UNK", "UNK"]


def test_canonical_ignores_case_and_outer_blanks(spark):
    got = column(spark, [" FASHION", "home & garden ", "odd", None], "string",
                 lambda c: canonical(c, ["Fashion", "Home & Garden"], "Unknown"))
    assert got == ["Fashion", "Home & Garden", "Unknown", "Unknown"]


def test_mixed_dates(spark):
    given = ["2024-03-05", "2024-1-5", "05/03/2024", "05-03-2024", "31/02/2024", " 2024-03-05", "x", None]
    got = column(spark, given, "string", mixed_date)
    assert [str(d) if d else None for d in got] == [
        "2024-03-05", "2024-01-05", "2024-03-05", "2024-03-05", None, None, None, None]
    assert column(spark, ["2024-02-30"], "string", lenient_date) == [None]
    assert column(spark, ["05-03-2024", "2024-03-05", "05/03/2024"], "string", dashed_not_iso) == [True, False, False]


def test_months_are_counted_by_boundary(spark):
    df = spark.sql("select date'2024-02-01' a, date'2024-01-01' b, date'2025-01-01' c")
    assert df.select(months_apart(F.col("a"), F.col("b")), months_apart(F.col("c"), F.col("b"))).first()[:] == (1, 12)


def test_ratio_is_null_on_zero(spark):
    df = spark.sql("select 1 a, 0 z, cast(null as int) n")
    assert df.select(ratio(F.col("a"), F.col("z")), ratio(F.col("a"), F.col("n"))).first()[:] == (None, None)


def test_round_to_works_on_the_binary_value(spark):
    assert column(spark, [1.005, 2.675, -2.5, 2.5], "double", lambda c: round_to(c, 2))[:2] == [1.0, 2.68]
    assert column(spark, [-2.5, 2.5, 0.5], "double", lambda c: round_to(c, 0)) == [-3.0, 3.0, 1.0]


def test_printed_numbers_match_correctly_rounded_printf(spark):
    rng = random.Random(5)
    values = [51.45, 12.35, 2.5, 3.5, 0.5, -0.5, 1234.5, 2.675, 1.005, 0.125, 0.0, 99999.995, 1e6 + 0.5]
    values += [round(rng.uniform(-1e6, 1e6), 2) for _ in range(1500)] + [rng.randrange(10**7) / 8 for _ in range(500)]
    for places in (0, 1, 2):
        got = column(spark, values, "double", lambda c: grouped_number(c, places))
        assert got == [f"{v:,.{places}f}" for v in values]
    signed = column(spark, [4.25, -4.35], "double", lambda c: plain_number(c, 1, sign=True))
    assert signed == [f"{v:+.1f}" for v in (4.25, -4.35)]


def test_dates_in_full_width_go_by_a_cast(spark):
    given = ["2024-02-29", "2023-02-29", "0000-01-01", "0999-01-01", "2024-01-02\n", " 2024-01-02", "29/02/2024", "31/04/2024", "31-12-2023",
             "1/2/2024", "01/02-2024", "12024-01-01", "", None]
    for ours, layouts in ((mixed_date, MIXED_DATE_LAYOUTS), (lenient_date, ("yyyy-M-d",))):
        assert column(spark, given, "string", lambda c, x=ours: x(c).cast("string")) == column(
            spark, given, "string", lambda c, x=layouts: F.coalesce(*[F.try_to_date(c, layout) for layout in x]).cast("string"))
        text = str(ours(F.col("v")))
        assert "CAST" in text.upper() and text.upper().index("CAST") < text.index("to_date")
