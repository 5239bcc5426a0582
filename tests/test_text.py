"""Cell cleaning, each case as a column."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallyboard.functions import text


def values(spark, cases, expression, kind="string"):
    rows = spark.createDataFrame([(i, case) for i, case in enumerate(cases)], f"i int, x {kind}")
    return [r[0] for r in rows.orderBy("i").select(expression(F.col("x"))).collect()]


def check(spark, cases, expression, kind="string"):
    assert values(spark, list(cases), expression, kind) == list(cases.values())


def test_to_int(spark):
    cases = {
        "61": 61, "8.0": 8, "-17": -17, " ": None, "": None, "n/a": None, " 13 ": 13, "-6.9": -6, "6.9": 6,
        "1e2": 100, ".5": 0, "nan": None, "inf": None, "-Infinity": None, "1d": None, "1f": None, "0x10": None,
        "1e400": None, "9" * 30: None, "\t8\n": 8, "+4": 4, "4.": 4,
    }
    check(spark, cases, text.to_int)
    assert values(spark, [None], text.to_int) == [None]


def test_to_text(spark):
    check(spark, {"  hello  ": "hello", "   ": None, "Alice": "Alice", " x ": "x", "": None}, text.to_text)
    assert values(spark, [-305, None], text.to_text, "int") == ["-305", None]


def test_hole_number(spark):
    cases = {
        "hole_4": 4, "hole_1": 1, "hole_27": 27, "hole_36": 36, "hole_0": None, "hole_37": None, "division": None,
        "": None, "HOLE_12": 12, "hole_": None, "hole_4x": None, "xhole_4": None, "hole4": None,
        "hole_99999999999999999999": None,
    }
    check(spark, cases, text.hole_number)


def test_event_name(spark):
    cases = {
        "Harbour-Cup_20230311_20230312_170559.csv": "Harbour Cup",
        "Round-2-of-5-2023-03-11_20230312_000001.csv": "Round 2 of 5",
        "/in/2023/Harbour-Cup_20230311_20230312_170559.csv": "Harbour Cup",
        "s3a://b/Harbour Cup_20230311_20230312_170559.csv": "Harbour Cup",
        "scores.csv": "scores",
        "last-one": "last one",
        "v2.0-final_20230311_20230312_170559.csv": "v2.0 final",
    }
    check(spark, cases, text.event_name)


def test_download_time(spark):
    cases = {
        "Round-2-of-5-2023-03-11_20230312_000001.csv": datetime(2023, 3, 12, 0, 0, 1),
        "Harbour-Cup_20230311_20230312_170559.csv": datetime(2023, 3, 12, 17, 5, 59),
        "Harbour-Cup_20231301_250000.csv": None,
        "x_20230311_20230312_240000.csv": None,
        "scores.csv": None,
        "": None,
    }
    check(spark, cases, text.download_time)


def test_lists(spark):
    check(
        spark,
        {
            "https://one.example/x": ["https://one.example/x"],
            "q|r|s|t": ["q", "r", "s", "t"],
            "\tq | r ": ["q", "r"],
            "": [],
            "|q| |r||": ["q", "r"],
            " | |": [],
        },
        text.split_list,
    )
    assert values(spark, [None], text.split_list) == [[]]
    lists = [["q", "r", "s"], [" q"], [], ["", "q", "\t"], None, [None, "r ", "q"]]
    assert values(spark, lists, text.join_list, "array<string>") == ["q|r|s", "q", "", "q", None, "r|q"]
    assert values(spark, ["q|r", "s"], lambda c: text.join_list(text.split_list(c))) == ["q|r", "s"]


@pytest.mark.parametrize("default", [True, False, None])
def test_flags(spark, default):
    cases = {word: True for word in ("TRUE", " 1", "Yes", "y", "oN\t")}
    cases |= {word: False for word in ("FALSE", "0 ", "nO", "n", "off")}
    cases |= {" ": default, "maybe": default, "10": default}
    check(spark, cases, lambda c: text.to_flag(c, default))
    assert values(spark, [None], lambda c: text.to_flag(c, default)) == [default]


def test_column_key(spark):
    cases = {
        "TotalPar": "totalpar", "Total Par": "totalpar", "(Points) won?": "pointswon", "pay_out": "pay_out",
        "HOLE-11": "hole11", "Hole_11": "hole_11", "﻿Division": "division", "2024": "2024",
    }
    check(spark, cases, text.column_key)
