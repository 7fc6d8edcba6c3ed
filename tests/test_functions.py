"""Column expressions: keys, dates, numbers, JSON tests, text (FIXTURES 2.1, 2.4)."""

from pyspark.sql import functions as F

from lodestone.functions import (date_is_invalid, falsy_to_null_double, first_map_value,
                                 has_key, identity_text, is_nonempty_object, labelled_join,
                                 parse_multi_date, py_strip, safe_double, slugify, url_from_title)


def one(spark, schema, rows, *cols):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*cols).collect()]


def test_slugify(spark):
    got = one(spark, "n string", [("Prionace glauca",), ("",), (None,), ("Hello World! @#$%",)],
              slugify("n"))
    assert got == [("prionace_glauca",), ("",), ("",), ("hello_world!_@#$%",)]


def test_date_shapes(spark):
    valid = ["2020", "2020-06-15", "2020-06-15T10:00:00", "2020-6-5", "2020-06-15t10:00:00", "", None]
    invalid = ["2020-06", "2020-06-15T10:00:00Z", "2020-01-01/2020-02-01", "0000", "-2020",
               "2020-006-15", "2020-02-30", "not-a-date"]
    rows = [(v,) for v in valid + invalid]
    got = one(spark, "v string", rows, "v", date_is_invalid("v"), parse_multi_date("v"))
    assert [g[1] for g in got] == [False] * len(valid) + [True] * len(invalid)
    parsed = {g[0]: g[2] for g in got}
    assert parsed["2020"].year == 2020 and parsed["2020"].month == 1
    assert parsed["2020-06-15T10:00:00"].hour == 10
    assert parsed["2020-6-5"].day == 5 and parsed[""] is None


def test_numbers(spark):
    got = one(spark, "v string", [("1.5",), ("abc",), ("",), ("0",), (None,), ("NaN",)],
              safe_double("v"), falsy_to_null_double("v"))
    assert got[0] == (1.5, 1.5)
    assert got[1] == (None, None) and got[2] == (None, None)
    assert got[3] == (0.0, None) and got[4] == (None, None)


def test_json_object_tests(spark):
    rows = [("text",), ("{}",), ("[]",), ("null",), ("5",), ('{"a": null}',), (None,)]
    got = one(spark, "v string", rows, is_nonempty_object("v"), has_key("v", "a"))
    assert [g[0] for g in got] == [False, False, False, False, False, True, False]
    assert [g[1] for g in got] == [False, False, False, False, False, True, False]


def test_first_map_value_keeps_json_order(spark):
    df = spark.createDataFrame([('{"9": {"e": "first"}, "1": {"e": "second"}}',)], "j string")
    m = F.from_json("j", "map<string, struct<e: string>>")
    assert df.select(first_map_value(m)["e"]).first()[0] == "first"


def test_text_helpers(spark):
    got = one(spark, "s string, k string",
              [(" \n\t x y   \x1c", "key")],
              py_strip("s"), identity_text(F.lit("Great white shark"), F.col("k")),
              url_from_title("https://w/", F.lit("Great white shark")))
    assert got == [("x y", "Species: Great white shark (key)", "https://w/Great_white_shark")]
    j = one(spark, "a string, b string, c string", [("Animalia", "", None), (None, None, None)],
            labelled_join([("kingdom", F.col("a")), ("phylum", F.col("b")), ("rank", F.col("c"))]))
    assert j == [("kingdom: Animalia",), (None,)]
