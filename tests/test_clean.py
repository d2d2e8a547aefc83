"""Edge cases of the cleansing rules, each as one table of (input, expected)."""

import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F

from tablebridge.functions import clean as c
from tablebridge.functions import keys as k

V = F.col("v")


def check(spark, column, cases):
    rows = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(cases)], "i int, v string")
    got = {r.i: r.out for r in rows.select("i", column.alias("out")).collect()}
    wrong = [(v, want, got[i]) for i, (v, want) in enumerate(cases) if got[i] != want]
    assert not wrong, wrong


def ts(text):
    return dt.datetime.fromisoformat(text)


def test_norm_key(spark):
    check(spark, c.norm_key(V), [("﻿ 12 ", "12"), (" \t　", None), (None, None), ("a b", "a b")])
    check(spark, c.match_key(V), [("007", "7"), ("000", "0"), ("AbC", "abc"), ("0x", "0x"), (" ", None)])


def test_null_if_blank_words(spark):
    check(spark, c.null_if_blank(V, ["null"]), [("NULL", None), (" Null ", None), ("nullx", "nullx"), ("", None)])


def test_clamp(spark):
    text, cut = c.clamp_text(V, 3)
    check(spark, text, [("abcd", "abc"), (" abc ", "abc"), (None, None)])
    check(spark, cut, [("abcd", True), (" abc ", False), (None, False)])


def test_int(spark):
    check(spark, c.to_int_strict(V), [(" -12 ", -12), ("1.0", None), ("+1", None), ("1" * 18, int("1" * 18)), ("1" * 19, int("1" * 19)), ("9" * 19, None), ("12a", None), ("", None)])
    check(spark, c.to_int_strict(V, 3, signed=False), [("-1", None), ("123", 123), ("1234", None)])


def test_real(spark):
    check(
        spark, c.to_real_lenient(V),
        [
            ("151,5", 151.5), ("151, 5", 151.5), ("58.", 58.0), ("+5", 5.0), ("5+", 5.0), ("5-", 5.0), ("-5", -5.0), ("1e3", 1000.0),
            ("1,000.5", None), ("abc", None), ("", None), (None, None), ("NaN", None), ("1d", None), ("58.-", None), (".5", None), ("1 2", 12.0), ("+-5", -5.0),
        ],
    )
    check(spark, c.to_real_lenient(V, money=True), [("1,234.50", decimal.Decimal("1234.5000")), ("1 2", None), ("x", None)])


def test_bool_and_flag(spark):
    check(spark, c.to_bool(V), [("Y", True), ("f", False), ("yes", None), ("TRUE", None), (" 1 ", True), ("", None)])
    check(spark, c.to_bool(V, "sql"), [("YES", True), ("No", False), ("x", None)])
    check(spark, c.to_bool(V, default=False), [("x", False), ("T", True)])
    check(spark, c.to_int_flag(V), [("Y", 1), ("n", 0), ("7", 7), ("x", None)])
    with pytest.raises(ValueError):
        c.to_bool(V, "other")


def test_era_thresholds(spark):
    late, early = c.be_to_timestamp(V, 2400), c.be_to_timestamp(V, 2200)
    check(
        spark, late,
        [
            ("2199-01-01", ts("2199-01-01")), ("2200-01-01", ts("2200-01-01")), ("2399-01-01", ts("2399-01-01")),
            ("2400-01-01", ts("1857-01-01")), ("2567-02-29", ts("2024-02-29")), ("2566-02-29", None), ("2023-02-29", None),
            ("2567-02-29T10:11:12.345Z", ts("2024-02-29T10:11:12")), (" 2024-01-02 03:04:05", ts("2024-01-02T03:04:05")),
            ("2024-01-02 03:04", ts("2024-01-02")), ("2024-01-02 25:00:00", None), ("24-01-02", None), ("soon", None), ("", None), (None, None),
            ("2024-13-01", None), ("2024/01/02", None),
        ],
    )
    check(spark, early, [("2199-01-01", ts("2199-01-01")), ("2200-01-01", ts("1657-01-01")), ("2399-12-31", ts("1856-12-31"))])
    check(spark, c.be_to_timestamp(V, 2400, time_after_t=False), [("2024-01-02T03:04:05", ts("2024-01-02")), ("2024-01-02 03:04:05", ts("2024-01-02T03:04:05"))])
    check(spark, c.be_to_timestamp(V, 2400, keep_time=False), [("2024-01-02 03:04:05", ts("2024-01-02"))])
    check(spark, c.be_to_text(V, 2200), [("2567-02-30 01:02:03", "2024-02-30 01:02:03"), ("2567-01-01", "2024-01-01 00:00:00"), ("x", None)])


def test_dates_and_epochs(spark):
    check(spark, c.parse_iso_date(V), [("2024-01-02T09", dt.date(2024, 1, 2)), ("2023-02-29", None), ("2567-01-01", dt.date(2567, 1, 1)), ("2024-1-2", None)])
    check(spark, c.to_epoch(V), [("0", None), ("1", None), ("1700000000", 1700000000), ("1970-01-02 00:00:01", 86401), ("2513-01-01", 0), ("x", None)])
    check(spark, c.clock_slot(c.be_to_timestamp(V, 2400)), [("2024-01-02 03:04:05", "03:04")])
    check(spark, c.slot_label(V), [("8:5", "08:05"), ("10:30", "10:30"), ("noon", "noon"), ("8:5:1", "08:05"), ("", None)])
    check(spark, c.wall_clock_to_instant(c.be_to_timestamp(V, 2400), "Asia/Bangkok"), [("2024-01-01 07:00:00", ts("2024-01-01"))])


def test_text_rules(spark):
    check(spark, c.digits_or_text(V), [("1-23 4", "1234"), (" abc ", "abc"), ("", None)])
    check(spark, c.clean_person_name(V), [("﻿Ann  B  ", "Ann B"), (" ", None)])
    check(spark, c.is_searchable_name(V), [("-", False), ("0", False), ("ก", True), (None, False)])
    check(spark, c.guard_uuid(V), [("A0EEBC99-9C0B-4EF8-BB6D-6BB9BD380A11", "a0eebc99-9c0b-4ef8-bb6d-6bb9bd380a11"), ("a0eebc99-9c0b-6ef8-bb6d-6bb9bd380a11", None), ("x", None)])
    check(spark, c.to_json_array(V), [("5", "[5]"), ("a\"b", '["a\\"b"]'), ("", None)])
    check(spark, c.to_json_array(V, null_as_empty=True), [("", "[]")])
    check(spark, c.remap_code_list(V, {6: 20}), [("6", "[20]"), ("1,6", "[1,20]"), ("1|6", "[1,20]"), ('["1","6"]', "[1,20]"), ("free 6", '["free 6"]'), ("", "[]")])
    check(spark, c.int_or_text_id(V), [("007", "7"), (" x1 ", "x1"), ("", None)])


def test_phones(spark):
    cases = [
        (("021234567/0812345678", None), ("0812345678", "021234567")),
        (("0812345678", "02"), ("0812345678", "02")),
        (("x/y", "z"), ("x/y", "z")),
        ((None, "02-123-4567 / 0912345678"), ("0912345678", "021234567")),
        (("0812345678 / 0912345678", "5"), ("0812345678", "5")),
    ]
    rows = spark.createDataFrame([(i, *v) for i, (v, _) in enumerate(cases)], "i int, b string, h string")
    biz, home = c.split_phones(F.col("b"), F.col("h"))
    got = {r.i: (r.biz, r.home) for r in rows.select("i", biz.alias("biz"), home.alias("home")).collect()}
    assert got == {i: want for i, (_, want) in enumerate(cases)}
    check(spark, F.array_join(c.phone_digit_set(V), ","), [("+66812345678, 0812345678;1", "0812345678"), ("021234567|0812345678", "021234567,0812345678")])


def test_keys(spark):
    check(spark, k.composite_key(V, F.lit("b"), sep="|"), [("a", "a|b"), (" ", None)])
    check(spark, k.id_sort_text(V), [("12", "0" + "12".zfill(20)), ("x", "1x")])
    prints = k.row_fingerprint({"K": V}, {"F": F.lit(None).cast("string")})
    check(spark, prints == F.sha2(F.lit("K:~|F:"), 256), [(" ", True), ("a", False)])


def test_synthetic_key_is_stable_and_unique(spark):
    rows = spark.createDataFrame([("", "a"), ("", "a"), (" ", "b"), ("k", "a")], "key string, f string")
    first = sorted(r.key for r in k.synthetic_key(rows, "key", ["f"], "gen_").collect())
    again = sorted(r.key for r in k.synthetic_key(rows.repartition(3), "key", ["f"], "gen_").collect())
    assert first == again and len(set(first)) == 4 and "k" in first
