import pytest
from pyspark.sql import functions as F

from fiscalmill.functions import arith, text, web
from fiscalmill.functions.keys import surrogate_key


def column(df, expression):
    return [r[0] for r in df.select(expression).collect()]


def test_surrogate_key_golden(frame):
    df = frame("a string, b string, c string", ("a", "b", "c"), ("a", None, "c"), (None, None, "c"), (None, None, None))
    assert column(df, surrogate_key("a", "b", "c")) == [
        "7b193b3d33184464106f41ddf733783b", "4f32a73dc87b7bbb7a654d8898d58c7e",
        "d9c538b129f1a3ad6ecfe55345c32a05", "2fa5491950d66d153d23cfbcfea4e164",
    ]
    assert column(df, surrogate_key("a"))[0] == "0cc175b9c0f1b6a831c399e269772661"
    assert column(df, surrogate_key("a"))[3] == "f14cc5cdce0420f4a5a6b6d9d7b85f39"
    assert column(df, surrogate_key("b", nulls_as_empty=True))[1] == "d41d8cd98f00b204e9800998ecf8427e"
    with pytest.raises(ValueError):
        surrogate_key()


def test_safe_add_and_subtract(frame):
    df = frame("a int, b int, c int", (1, 2, 3), (1, None, 3), (None, None, 2), (None, None, None))
    assert column(df, arith.safe_add("a", "b", "c")) == [6, 4, 2, 0]
    df = frame("a int, b int, c int", (3, 2, 1), (4, None, 3), (None, None, 2), (None, None, None))
    assert column(df, arith.safe_subtract("a", "b", "c")) == [0, 1, -2, 0]


def test_safe_divide(frame):
    df = frame("n int, d int", (6, 0), (10, 5), (None, None), (None, 0), (17, None), (0, None), (None, 9), (0, 5))
    assert column(df, arith.safe_divide("n", "d")) == [None, 2, None, None, None, None, None, 0]
    df = frame("a int, b int, d int", (0, 5, 9), (2, 3, 0), (0, 0, 0), (3, 4, None), (None, 6, 14), (2, 5, 2))
    assert column(df, arith.safe_divide(F.col("a") * F.col("b"), "d")) == [0, None, None, None, None, 5]
    df = frame("n int, a int, b int", (None, 0, 4), (6, 3, 2), (0, 2, 6), (0, None, 8), (5, None, 2), (4, 0, 4))
    assert column(df, arith.safe_divide("n", F.col("a") * F.col("b"))) == [None, 1, 0, None, None, None]


def test_width_bucket(frame):
    df = frame("x double", *[(x,) for x in (190000.0, 290000.0, 320000.0, 399999.99, 400000.0, 470000.0, 510000.0, 610000.0)])
    assert column(df, arith.width_bucket("x", 200000, 600000, 4)) == [0, 1, 2, 2, 3, 3, 4, 5]


def test_haversine(frame):
    df = frame("a double, b double, c double, d double", (48.864716, 2.349014, 52.379189, 4.899431))
    assert column(df, F.round(arith.haversine_distance("a", "b", "c", "d", "km"))) == [430.0]
    assert column(df, F.round(arith.haversine_distance("a", "b", "c", "d"))) == [267.0]
    with pytest.raises(ValueError):
        arith.haversine_distance("a", "b", "c", "d", "ft")


URLS = [
    ("www.google.co.uk?utm_source=google", "www.google.co.uk", ""),
    ("http://witanddelight.com/2018/01/tips/?utm_source=x", "witanddelight.com", "2018/01/tips/"),
    ("https://www.nytimes.com/2018/01/01/blog", "www.nytimes.com", "2018/01/01/blog"),
    ("android-app://m.facebook.com/", "m.facebook.com", None),
    ("docs.nytimes.com/2021/01/01/index.js?utm_source=google", "docs.nytimes.com", "2021/01/01/index.js"),
    ("https://m.facebook.com/", "m.facebook.com", ""),
    ("plain.host", "plain.host", "plain.host"),
]


def test_url_parts(frame):
    df = frame("u string", *[(u,) for u, _, _ in URLS])
    assert column(df, web.url_host("u")) == [h for _, h, _ in URLS]
    paths = column(df, web.url_path("u"))
    assert all(want is None or have == want for have, (_, _, want) in zip(paths, URLS))
    df = frame("u string", ("http://drewbanin.com/milky?utm_medium=organic",), ("http://x.com?utm_medium=organic&utm_source=github",))
    assert column(df, web.url_parameter("u", "utm_medium")) == ["organic", "organic"]
    assert column(df, web.url_parameter("u", "utm_source")) == [None, "github"]
    assert column(df, web.url_parameter("u", "source")) == [None, "github"]


def test_dirty_numbers(frame):
    df = frame("x string", ("1,2345",), (" 0,5 ",), ("n.d.",), ("",), (None,), ("1.234,56",), ("1d",), ("-1.5e3",), ("\t7\xa0",))
    assert column(df, text.decimal_comma("x")) == [1.2345, 0.5, None, None, None, None, None, -1500.0, 7.0]
    df = frame("x string", ("7037.0",), ("-5",), ("12 hab",), (None,), ("nan",), ("1.2.3",), ("12.9",), ("4-2",))
    assert column(df, text.integer_text("x")) == ["7037", "-5", "12 hab", None, "nan", "1.2.3", "12", "4-2"]


def test_grades_and_words(frame):
    df = frame("x string", ("n.d.",), (" n.d. ",), ("",), (" b ",), (None,))
    assert column(df, text.grade("x", "n.d.", "")) == [None, "N.D.", None, "B", None]
    df = frame("x string", ("nan",), ("None",), ("none",), (None,), ("NaN",))
    assert column(df, text.blank_null_words("x")) == ["", "", "", "", "NaN"]


def test_state_from_code(frame):
    df = frame("c bigint", (3550308,), (5300108,), (9900000,), (None,))
    assert column(df, text.state_from_code("c")) == ["SP", "DF", None, None]
