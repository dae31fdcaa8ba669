"""Text and time expressions."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions.text import clean_text, flag, normalise_name, split_list
from tidemark.functions.timestamps import (
    cdc_cutoff,
    format_watermark,
    load_partition,
    parse_timestamp,
    parse_watermark,
    zero_date_to_null,
)


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize(
    "text, value",
    [
        ("2024-03-10 02:30:05", datetime(2024, 3, 10, 2, 30, 5)),
        ("2024-03-10 02:30:05.25", datetime(2024, 3, 10, 2, 30, 5, 250000)),
        ("2024-03-10T02:30:05.123456Z", datetime(2024, 3, 10, 2, 30, 5, 123456)),
        ("2024-03-10T02:30:05Z", datetime(2024, 3, 10, 2, 30, 5)),
        ("2024-3-1 2:3:4", datetime(2024, 3, 1, 2, 3, 4)),
        ("2024-03-10T02:30:05", None),
        ("2024-03-10", None),
        ("2024-02-30 00:00:00", None),
        ("2024-03-10 02:30:05 ", None),
        ("0000-00-00 00:00:00", None),
        ("soon", None),
        ("", None),
        (None, None),
    ],
)
def test_timestamp_text(spark, setting, zone, text, value):
    setting("spark.sql.session.timeZone", zone)
    assert one(spark, parse_timestamp(F.lit(text).cast("string"))) == (value,)


def test_watermark_text_has_no_zulu_form(spark):
    assert one(spark, parse_watermark(F.lit("2024-03-10T02:30:05Z"))) == (None,)
    assert one(spark, parse_watermark(F.lit("2024-03-10 02:30:05.5"))) == (datetime(2024, 3, 10, 2, 30, 5, 500000),)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_cutoff_goes_back_and_down_to_the_minute(spark, setting, zone):
    setting("spark.sql.session.timeZone", zone)
    mark = F.lit("2001-07-01 10:23:45.5")
    assert one(spark, cdc_cutoff(mark, 10), cdc_cutoff(mark, 5)) == (
        datetime(2001, 7, 1, 10, 13),
        datetime(2001, 7, 1, 10, 18),
    )
    # The hour that New York skips exists for a zone-free time.
    assert one(spark, cdc_cutoff(F.lit("2024-03-10 02:40:00"), 10)) == (datetime(2024, 3, 10, 2, 30),)


def test_watermark_is_written_with_six_digits_or_none(spark):
    got = one(spark, *[format_watermark(F.lit(t)) for t in ("2024-01-02 03:04:05.1", "2024-01-02 03:04:05.000")])
    assert got == ("2024-01-02 03:04:05.100000", "2024-01-02 03:04:05")


def test_zero_dates(spark):
    texts = ["0000-00-00", "0000-00-00 00:00:00", "2024-01-02", "bad", None]
    got = one(spark, *[zero_date_to_null(F.lit(t).cast("string")) for t in texts])
    assert got == (None, None, datetime(2024, 1, 2), None, None)


def test_load_partition_is_in_the_load_zone(spark):
    assert one(spark, *load_partition("2025-11-05 18:30:00")) == ("2025-11-06", "00")
    assert one(spark, *load_partition(datetime(2025, 11, 5, 3, 29), zone="UTC")) == ("2025-11-05", "03")


def test_text(spark):
    got = one(
        spark,
        *[clean_text(F.lit(t).cast("string")) for t in ("\t a b \n", "  ", "", None)],
        *[flag(F.lit(t).cast("string")) for t in (" true ", "TRUE", "yes", None)],
        normalise_name(F.lit("Shop_a")),
        split_list(F.lit(" a ,b,\tc c")),
    )
    assert got == ("a b", None, None, None, True, True, False, False, "SHOP_A", ["a", "b", "c c"])
