from datetime import datetime
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from tidemark import functions as fn


def one(spark, column, **values):
    frame = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return frame.select(column.alias("x")).first().x


def test_json_paths(spark):
    data = '{"a":{"b":true},"n":null,"s":"x","i":7}'
    get = lambda path: one(spark, fn.json_str(F.col("d"), path), d=data)
    assert (get("$.a.b"), get("$.n"), get("$.s"), get("$.i"), get("$.zz")) == ("true", None, "x", "7", None)
    assert one(spark, fn.json_str(F.col("d"), "$.a"), d="{bad") is None


def test_truthy_and_present_differ_on_empty_values(spark):
    a, b = F.lit(0), F.lit(None).cast("int")
    assert one(spark, fn.first_present(a, b)) == 0
    assert one(spark, fn.first_truthy(a, b, 0)) is None
    assert one(spark, fn.first_truthy(F.lit(3), b, 0)) == 3
    assert one(spark, fn.first_truthy(F.lit(""), F.lit("z"), "")) == "z"


def test_casts_yield_null_instead_of_errors(spark):
    assert one(spark, fn.safe_cast(F.lit("12"), "int")) == 12
    assert one(spark, fn.safe_cast(F.lit("x1"), "int")) is None


@pytest.mark.parametrize("session_zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize("tz", ["UTC", "Asia/Kolkata", "Europe/Berlin"])
def test_day_does_not_depend_on_the_session_zone(spark, session_zone, tz):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        for ms in (1_705_861_799_999, 1_705_861_800_000, 1_711_846_800_000, 0):
            want = datetime.fromtimestamp(ms / 1000, ZoneInfo(tz)).strftime("%Y-%m-%d")
            assert one(spark, fn.ms_to_day(F.col("ms"), tz), ms=ms) == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_floor_div_is_exact_below_zero(spark):
    values = [-1, 0, 1, 86_399_999, 86_400_000, -86_400_000, -86_400_001]
    frame = spark.createDataFrame([(v,) for v in values], "v bigint")
    got = [r.x for r in frame.select(fn.floor_div(F.col("v"), 86_400_000).alias("x")).collect()]
    assert got == [v // 86_400_000 for v in values]


def test_ratios(spark):
    n, zero, two = F.lit(1), F.lit(0), F.lit(2)
    assert one(spark, fn.ratio_or_null(n, zero)) is None
    assert one(spark, fn.ratio_or_null(n, two)) == 0.5
    assert one(spark, fn.ratio_or_zero(n, zero)) == 0.0
    assert one(spark, fn.ratio_or_zero(n, two)) == 0.5


def test_labels_flags_and_lengths(spark):
    yes, no = F.lit(True), F.lit(False)
    assert one(spark, fn.label_y(yes, yes)) == 2
    assert one(spark, fn.label_y(no, yes)) == 1
    assert one(spark, fn.label_y(no, no)) == 0
    assert one(spark, fn.title_len(F.lit("abc"), F.lit(9))) == 9
    assert one(spark, fn.title_len(F.lit(None).cast("string"), F.lit(None).cast("int"))) == 0
    assert one(spark, fn.title_len(F.lit(None).cast("string"))) is None
    assert one(spark, fn.origin_post(F.lit("post_p12"))) == "p12"
    assert one(spark, fn.has_media(F.lit(None).cast("boolean"), F.lit(3.0))) is True
    assert one(spark, fn.classified(F.lit("t"), F.lit(""), truthy=True)) == 0
    assert one(spark, fn.classified(F.lit("t"), F.lit(""))) == 1
    assert one(spark, fn.minutes_between(F.lit(0), F.lit(90_000))) == -1


def test_iso_run_times(spark):
    assert one(spark, fn.to_epoch_ms(F.lit("2024-01-21T17:30:00+05:30"))) == 1_705_838_400_000


def test_run_and_window_parameters():
    run = fn.run_params(1_705_838_400_000)
    assert (run.date, run.slot, run.iso) == ("2024-01-21", "1730", "2024-01-21T17:30:00+05:30")
    bounds = fn.window_bounds("2024-01-21")
    assert bounds.window_start == fn.day_ms("2024-01-14") == bounds.prior_end
    assert bounds.prior_start == fn.day_ms("2024-01-07")
    assert (bounds.first_date, bounds.last_date) == ("2024-01-07", "2024-01-21")
