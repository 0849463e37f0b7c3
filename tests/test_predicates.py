import pytest
from pyspark.sql import functions as F

from shoptrail.functions import columns as C
from shoptrail.functions import predicates as P
from shoptrail.params import TaskParams

OPEN = TaskParams("2024-01-01", "2024-01-31")


@pytest.fixture(scope="module")
def users(spark):
    rows = [
        (1, 20, "p1", "c1", "male"),
        (2, 50, "p2", "c2", "female"),
        (3, 51, "p1", "c2", "male"),
        (4, None, None, None, None),
        (5, 30, "-1", "c1", "female"),
    ]
    return spark.createDataFrame(rows, "user_id bigint, age int, professional string, city string, sex string")


def ids(df):
    return sorted(r.user_id for r in df.collect())


@pytest.mark.parametrize(
    ("changes", "expected"),
    [
        ({}, [1, 2, 3, 4, 5]),
        ({"start_age": 20, "end_age": 50}, [1, 2, 5]),
        ({"start_age": 20}, [1, 2, 3, 4, 5]),
        ({"end_age": 50}, [1, 2, 3, 4, 5]),
        ({"professionals": ("p1",)}, [1, 3]),
        ({"professionals": ("-1",)}, []),
        ({"professionals": ("-1", "p2")}, [2]),
        ({"cities": ("c1", "c2")}, [1, 2, 3, 5]),
        ({"sex": ""}, [1, 2, 3, 4, 5]),
        ({"sex": "male"}, [1, 3]),
        ({"sex": "male", "cities": ("c2",)}, [3]),
    ],
)
def test_user_conditions(users, changes, expected):
    assert ids(P.keep(users, P.user_conditions(OPEN.replace(**changes)))) == expected


def test_period_is_inclusive(spark):
    df = spark.createDataFrame([(d,) for d in ("2023-12-31", "2024-01-01", "2024-01-31", "2024-02-01")], "date string")
    assert [r.date for r in P.in_period(df, OPEN).collect()] == ["2024-01-01", "2024-01-31"]


def test_params_from_json_with_unquoted_names(spark):
    text = (
        '{startDate:"2018-09-01", endDate:"2018-09-30", startAge: 20, endAge: 50, professionals: "", '
        'cities: "a,b", sex:"", keywords:"", categoryIds:"3,4", targetPageFlow:"1,2,3"}'
    )
    params = TaskParams.from_json(spark, text, sample_size=7)
    assert (params.start_date, params.end_date, params.start_age, params.end_age) == ("2018-09-01", "2018-09-30", 20, 50)
    assert params.professionals == () and params.sex is None and params.keywords == ()
    assert params.cities == ("a", "b")
    assert params.category_ids == (3, 4) and params.page_flow == (1, 2, 3) and params.sample_size == 7


def test_params_need_dates(spark):
    with pytest.raises(ValueError):
        TaskParams.from_json(spark, '{"startDate": "2018-09-01"}')


def test_each_task_gets_its_own_id():
    assert TaskParams("a", "b").task_id != TaskParams("a", "b").task_id


def test_time_text_with_one_digit_hour(spark):
    row = spark.createDataFrame([("2024-01-01 5:03:02", "2024-01-01 15:03:02", "junk")], "a string, b string, c string")
    a, b, c = (C.parse_time(F.col(n)) for n in "abc")
    shown = row.select(
        C.date_hour(a).alias("hour"),
        C.minute_key(b).alias("minute"),
        C.seconds_between(a, b).alias("seconds"),
        (a < b).alias("before"),
        c.isNull().alias("unreadable"),
    ).first()
    assert tuple(shown) == ("2024-01-01_05", "202401011503", 36000, True, True)


def test_id_list_skips_empty_and_text_items(spark):
    df = spark.createDataFrame([("3,,4",), ("x,5",), ("",), (None,)], "ids string")
    assert [r[0] for r in df.select(C.id_list(F.col("ids"))).collect()] == [[3, 4], [5], [], None]


def test_ratio_rounds_half_up_and_survives_zero(spark):
    df = spark.createDataFrame([(57, 200), (1, 0), (1, 8)], "a bigint, b bigint")
    assert [r[0] for r in df.select(C.ratio(F.col("a"), F.col("b"), 2)).collect()] == [0.29, None, 0.13]
