import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from wardhouse import functions as W
from wardhouse.plans import vocabulary as v


@pytest.fixture(params=["true", "false"], ids=["ansi", "no-ansi"])
def any_mode(spark, request):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield spark
    spark.conf.set("spark.sql.ansi.enabled", before)


def apply(spark, expression, *values, types="string"):
    names = [f"c{i}" for i in range(len(values[0]) if isinstance(values[0], tuple) else 1)]
    rows = [x if isinstance(x, tuple) else (x,) for x in values]
    ddl = ", ".join(f"{n} {t}" for n, t in zip(names, types if isinstance(types, list) else [types] * len(names)))
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {ddl}")
    return [r.x for r in df.select("i", expression(*names).alias("x")).orderBy("i").collect()]


def test_codes_and_names(any_mode):
    assert apply(any_mode, W.clean_code, " bn01 ", None, "  ") == ["BN01", None, ""]
    assert apply(any_mode, W.clean_name, "  NGUYEN \t  van  an ", "đức-ANH", "x-QUANG phổi") == [
        "Nguyen Van An", "Đức-anh", "X-quang Phổi",
    ]
    assert apply(any_mode, W.clean_status, " completed", None) == ["COMPLETED", "UNKNOWN"]
    assert apply(any_mode, W.is_blank, "a", " ", None) == [False, True, True]


def test_categories(any_mode):
    gender = lambda c: W.standardize(c, v.PATIENT_GENDER, v.UNKNOWN)
    assert apply(any_mode, gender, " NAM giới ", "Woman", "khac", "?", None) == ["Nam", "Nữ", "Khác", v.UNKNOWN, v.UNKNOWN]
    city = lambda c: W.standardize(c, v.CITY)
    assert apply(any_mode, city, "TP.HCM", "vung  TAU", None) == ["TP. Hồ Chí Minh", "Vung Tau", None]
    title = lambda c: W.standardize(c, v.ACADEMIC_TITLE, F.trim(F.col(c)))
    assert apply(any_mode, title, "Bac si", " PGS ") == ["BS", "PGS"]


def test_date_shapes(any_mode):
    day = dt.date(1943, 12, 9)
    texts = ["1943-12-09", "09/12/1943", "19431209", "1943/12/09", "09-12-1943", "1943.12.09"]
    assert apply(any_mode, W.parse_date, *texts) == [day] * 6
    bad = ["2026-02-30", "30/02/2026", "5/5/26", "1943-12/09", "09.12.1943", "2026-05-055", "202605051", "2026", "2026-05", "x", "", None]
    assert apply(any_mode, W.parse_date, *bad) == [None] * len(bad)


def test_dates_with_one_digit_or_a_time_of_day(any_mode):
    texts = ["5/5/2026", "2026-5-05", " 2026.5.5", "2026-05-05 11:15:00", "20260505T11:15", "05-05-2026 x", "5-05-2026"]
    assert apply(any_mode, W.parse_date, *texts) == [dt.date(2026, 5, 5)] * 7
    strict = lambda c: W.parse_date(c, strict=True)
    assert apply(any_mode, strict, *texts, "2026-05-05", "20260505") == [None] * 7 + [dt.date(2026, 5, 5)] * 2


def test_date_fallbacks_and_other_patterns(any_mode):
    late = lambda a, b: W.parse_date(a, fallbacks=[b])
    rows = [("invalid", "2026-05-05 11:15:00"), ("2026-05-06", "2026-05-05 11:15:00"), (None, "no time"), (None, None)]
    assert apply(any_mode, late, *rows) == [dt.date(2026, 5, 5), dt.date(2026, 5, 6), None, None]
    english = lambda c: W.parse_date(c, formats=["yyyy-MM-dd", "d MMM yyyy"])
    assert apply(any_mode, english, "5 May 2026", "2026-05-05", "May") == [dt.date(2026, 5, 5), dt.date(2026, 5, 5), None]


def test_waiting_minutes(any_mode):
    rows = [
        ("2026-05-05 08:00:00", "2026-05-05 08:25:59"), ("2026-05-05 08:00:00", "2026-05-05 07:00:00"),
        (None, "2026-05-05 08:00:00"), ("2026-05-05 08:00:00", "bad"), ("2026-05-05", "2026-05-05 08:00:00"),
        ("0001-01-01 00:00:00", "9999-12-31 00:00:00"), ("2026-05-05 08:00:00.5", "2026-05-05 08:30:00.123"),
    ]
    assert apply(any_mode, W.elapsed_minutes, *rows) == [25, 0, 0, 0, 0, 2147483647, 30]


def test_birth_year_and_age(any_mode):
    year = lambda y, d: W.birth_year(y, d, "2026-06-01")
    rows = [("1983", "05/05/1990"), (None, "05/05/1990"), ("abc", "1950-04-28"), ("1899", None), ("2027", None), ("1983.7", None)]
    assert apply(any_mode, year, *rows) == [1983, 1990, 1950, None, None, 1983]
    band = lambda y: W.age_band(y, "2026-06-01")
    years = (2026, 2009, 2008, 1991, 1990, 1971, 1970, None)
    assert apply(any_mode, band, *years, types="int") == ["0-17", "0-17", "18-35", "18-35", "36-55", "36-55", "56+", v.UNKNOWN]


def test_money(any_mode):
    texts = ["150000", " 80,000", "250000 vnd", "200.000", "-50000", "abc", "", None, "1.005", "99999999999999999"]
    want = ["150000.00", "80000.00", "250000.00", "200.00", "-50000.00", None, None, None, "1.01", None]
    assert apply(any_mode, W.parse_money, *texts) == [w and Decimal(w) for w in want]
    thousands = lambda c: W.parse_money(c, dot_thousands=True)
    assert apply(any_mode, thousands, "200.000", "1.200.000 VND", "12.5") == [Decimal("200000"), Decimal("1200000"), Decimal("12.50")]


def test_whole_numbers(any_mode):
    texts = ["12.7", "-12.7", " 5 ", "1,000", "1e3", "abc", "9999999999", None]
    assert apply(any_mode, W.parse_int, *texts) == [12, -12, 5, 1000, None, None, None, None]


def test_rates(any_mode):
    texts = ["80", "80%", "0.8", "1.0", "1%", "0", " 95 % ", "120", "-5", "x", None]
    want = ["80", "80", "80", "100", "100", "0", "95", None, None, None, None]
    assert apply(any_mode, W.parse_rate, *texts) == [w and Decimal(w) for w in want]
    label = lambda c: W.rate_label(W.percent_value(c))
    assert apply(any_mode, label, "0", "0.8", "28.9", "0.29", "120") == ["Tự chi trả", "BHYT 80%", "BHYT 28%", "BHYT 28%", None]


def test_quantity_and_price_recovery(any_mode):
    money = "decimal(18,2)"
    types = ["int", money, money]
    d = Decimal
    rows = [(3, d(10), d(99)), (None, d(10), d(25)), (0, d(10), d(1)), (-1, None, d(50)), (None, None, None), (4, d(0), d(10)), (3, None, d(10))]
    assert apply(any_mode, W.recover_quantity, *rows, types=types) == [3, 3, 1, 1, 1, 4, 3]
    fixed = lambda q, p, t: W.recover_price(W.recover_quantity(q, p, t), p, t)
    assert apply(any_mode, fixed, *rows, types=types) == [d("10"), d("10"), d("10"), d("50"), d("0"), d("2.5"), d("3.33")]


def test_payment_split_rounds_both_shares_up(any_mode):
    df = any_mode.createDataFrame([(Decimal("10.05"), Decimal("50"))], "a decimal(18,2), r decimal(5,2)")
    shares = df.select(*W.split_payment("a", "r"), *W.split_payment("a", "r", balanced=True)).first()
    assert list(shares) == [Decimal("5.03"), Decimal("5.03"), Decimal("5.03"), Decimal("5.02")]


def test_labels_for_numbers_and_days(any_mode):
    numbers = (1.5e9, 2.25e6, 1234.5, 999.0, 1.2345e12)
    assert apply(any_mode, W.human_number, *numbers, types="double") == ["1.50B", "2.25M", "1,234", "999", "1234.50B"]
    plain = lambda c: W.human_number(c, 2, compact=False)
    assert apply(any_mode, plain, 1234.5, types="double") == ["1,234.50"]
    assert apply(any_mode, W.date_from_key, 20260131, 20260231, types="int") == [dt.date(2026, 1, 31), None]
    assert apply(any_mode, W.date_key, dt.date(2026, 1, 31), types="date") == [20260131]
