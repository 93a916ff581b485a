"""Casting rules of the batch load and of the stream, value by value."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from eventmart.functions import casts

ID = "0000000a-abcd-4000-8000-000000000001"


def time_text(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


@pytest.mark.parametrize(
    "expression, pairs",
    [
        (casts.batch_int, {" 12 ": 12, "12.0": None, "": None, "+5": 5, "-5": -5, "x": None, "3000000000": None}),
        (casts.batch_smallint, {"32767": 32767, "32768": None}),
        (casts.batch_rounded_smallint, {"1.5": 2, "-2.5": -3, "1.0": 1, "2.4": 2, "nan": None, "99999": None}),
        (casts.stream_int, {"3.9": 3, "-3.9": -3, "12": 12, "": None, "None": None, "x": None, "inf": None, "1d": None}),
    ],
)
def test_integers(evaluate, expression, pairs):
    assert evaluate(list(pairs), expression, "int") == list(pairs.values())


def test_batch_money_rounds_half_away_and_never_throws(evaluate):
    pairs = {"1.005": "1.01", "-1.005": "-1.01", "1e3": "1000.00", "123456789.00": None, "NaN": None, "1d": None}
    assert evaluate(list(pairs), casts.batch_money) == list(pairs.values())


def test_stream_money_on_special_texts(evaluate):
    texts = ["1e3", "123456789.00", "99999999.995", "NaN", "inf", "1d", "", "None", None, "1e-30", " 2.5 ", "-0.005"]
    want = ["1000.00", None, None, None, None, None, None, None, None, "0.00", "2.50", "-0.01"]
    assert evaluate(texts, casts.stream_money) == want


def test_stream_money_rounds_like_a_float(evaluate):
    rng = random.Random(7)
    texts = [f"{s}{i}.{j:03d}" for s in ("", "-") for i in (0, 1, 2, 17, 1023, 99_999_998) for j in range(5, 1000, 10)]
    texts += [f"{rng.uniform(-1e5, 1e5):.{rng.randint(0, 12)}f}" for _ in range(3_000)]
    texts += [f"{rng.randint(0, 10**10) / 1000:.3f}" for _ in range(3_000)]
    texts += [f"{rng.randint(0, 10**7)}.{rng.randint(0, 99):02d}5{'0' * rng.randint(0, 14)}1" for _ in range(3_000)]
    want = [f"{Decimal(repr(round(float(t), 2))):.2f}".replace("-0.00", "0.00") for t in texts]
    assert evaluate(texts, casts.stream_money) == want


def test_defaults(evaluate):
    assert evaluate(["x", None, "2.7"], lambda c: casts.stream_int(c, default=9), "int") == [9, 9, 2]
    assert evaluate(["x", "2.5"], lambda c: casts.stream_money(c, default=1.5)) == ["1.50", "2.50"]


def test_batch_sign_is_taken_before_rounding(evaluate):
    texts = ["-0.004", "-0.000000000000000000000001", "0", "5", None, "x", "99999999999"]
    assert evaluate(texts, casts.batch_negative, "boolean") == [True, True, False, False, None, None, None]


def test_offset_is_honoured_in_batch_and_discarded_in_stream(evaluate):
    texts = ["2024-10-01T10:00:00+07:00", "2024-10-01 10:00:00"]
    assert evaluate(texts, lambda c: time_text(casts.batch_timestamp(c))) == [
        "2024-10-01 03:00:00",
        "2024-10-01 10:00:00",
    ]
    assert evaluate(texts, lambda c: time_text(casts.stream_timestamp(c))) == ["2024-10-01 10:00:00"] * 2


def test_only_iso_shapes_are_times(evaluate):
    texts = ["now", "12:00", "2024", "not-a-time", "2024-13-01", "2024-10-01", "2024-10-01T10:00", "", None]
    want = [None] * 5 + ["2024-10-01 00:00:00", "2024-10-01 10:00:00"] + [None] * 2
    assert evaluate(texts, lambda c: time_text(casts.batch_timestamp(c))) == want
    assert evaluate(texts, lambda c: time_text(casts.stream_timestamp(c))) == want


def test_stray_blanks_around_times(evaluate):
    texts = [" 2024-10-01 10:00:00", "2024-10-01 10:00:00 "]
    assert evaluate(texts, lambda c: time_text(casts.batch_timestamp(c))) == ["2024-10-01 10:00:00"] * 2
    assert evaluate(texts, lambda c: time_text(casts.stream_timestamp(c))) == [None] * 2


def test_uuid_rules(evaluate):
    texts = [ID, ID.upper(), ID + "\n", " " + ID, "", None, "bad-1"]
    assert evaluate(texts, casts.is_uuid, "boolean") == [True, False, False, False, False, None, False]
    assert evaluate(texts, casts.stream_uuid) == [ID, ID, ID, ID, None, None, None]


def test_names(evaluate):
    texts = [" Card ", "\tCARD\v", "", "  ", None]
    assert evaluate(texts, casts.batch_name) == ["card", "\tcard\v", "", "", None]
    assert evaluate(texts, casts.stream_text) == ["card", "card", None, None, None]
    assert evaluate(["fever", "vf\f"], casts.stream_text) == ["fever", "vf"]


def test_numbers_a_column_cannot_hold(evaluate):
    def small(c):
        return casts.stream_out_of_range(c, casts.stream_int(c, to="smallint"), whole=True)

    def money(c):
        return casts.stream_out_of_range(c, casts.stream_money(c))

    texts = ["1", "70000", "inf", "nan", "-Infinity", "1e30", "x", "", None]
    want = [False, True, True, False, True, True, False, False, False]
    assert evaluate(texts, small, "boolean") == want
    assert evaluate(["123456789", "1.5", "nan"], money, "boolean") == [True, False, True]
