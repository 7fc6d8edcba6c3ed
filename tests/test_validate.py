"""Contract rules, first failure wins (FIXTURES 2.2-2.4), and the quarantine shape."""

import json

from pyspark.sql import functions as F

from lodestone.operators import rules as R
from lodestone.operators import validate as VAL

X50 = "x" * 50


def page_case(status, data, extracts=None):
    return (status, None if data is None else json.dumps(data),
            None if extracts is None else json.dumps(extracts))


def test_page_rules(spark):
    ok_ex = {"query": {"pages": {"1": {"extract": "== Section ==\nContent here"}}}}
    cases = [
        (page_case(404, None), "PAGE_NOT_FOUND"),
        (page_case(500, None), "HTTP_ERROR"),
        (page_case(200, {"title": "T", "extract": "short", "type": "standard"}, ok_ex),
         "EXTRACT_TOO_SHORT"),
        (page_case(200, {"title": "T", "extract": "short", "type": "disambiguation"}, ok_ex),
         "DISAMBIGUATION_PAGE"),
        (page_case(200, {"title": "T", "extract": X50}, {"query": {"pages": {"1": {"extract": ""}}}}),
         "MISSING_SECTIONS_TEXT"),
        ((200, "null", None), "PAGE_NOT_FOUND"),
        (page_case(200, {"title": "", "extract": X50}, ok_ex), "HTTP_ERROR"),
        (page_case(200, {"title": "T", "extract": X50}, ok_ex), None),
    ]
    rows = [(i, *c) for i, (c, _) in enumerate(cases)]
    df = spark.createDataFrame(rows, "k int, summary_status int, summary_data string, "
                                     "extracts_data string")
    got = {r.k: r for r in VAL.validate_pages(df, key="k").collect()}
    for i, (_, expected) in enumerate(cases):
        assert got[i][R.REASON] == expected, (i, got[i][R.REASON])
    ok = got[len(cases) - 1]
    assert ok.sections_text.startswith("== Section ==") and ok.resolved_via == "DIRECT_TITLE"
    assert got[2][R.CONTEXT] == {"species_key": "2", "extract_length": "5"}


def test_taxonomy_rules(spark):
    cases = [
        ((502, None), "HTTP_ERROR"),
        ((200, None), "NO_MATCH_RETURNED"),
        ((200, "{}"), "NO_MATCH_RETURNED"),
        ((200, "[1, 2]"), "NO_MATCH_RETURNED"),
        ((200, "plain text"), "NO_MATCH_RETURNED"),
        ((200, '{"matchType": "FUZZY", "usageKey": 1}'), "MATCH_TYPE_NOT_EXACT"),
        ((200, '{"usageKey": 1}'), "MATCH_TYPE_NOT_EXACT"),
        ((200, '{"matchType": "EXACT", "usageKey": null}'), "HTTP_ERROR"),
        ((200, '{"matchType": "EXACT", "usageKey": 5, "class": "Chondrichthyes"}'), None),
    ]
    df = spark.createDataFrame([(i, *c) for i, (c, _) in enumerate(cases)],
                               "k int, status int, data string")
    got = {r.k: r for r in VAL.validate_taxonomy(df, key="k").collect()}
    for i, (_, expected) in enumerate(cases):
        assert got[i][R.REASON] == expected, (i, got[i][R.REASON])
    ok = got[len(cases) - 1]
    assert (ok.usage_key, ok.scientific_name, ok.confidence, ok.class_name) == (5, "", 0, "Chondrichthyes")


def test_occurrence_rules(spark):
    cases = [
        ((None, "0.0", "0.0", "OBS", None), "MISSING_GBIF_ID"),
        (("999", None, None, "OBS", None), "MISSING_COORDINATES"),
        (("998", "999", "0", "OBS", None), "COORDINATES_OUT_OF_RANGE"),
        (("1", "abc", "0", "OBS", None), "COORDINATES_OUT_OF_RANGE"),
        (("1", "NaN", "0", "OBS", None), "COORDINATES_OUT_OF_RANGE"),
        (("1", "-90.0", "180", "OBS", None), None),
        (("996", "0.0", "0.0", None, None), "MISSING_BASIS_OF_RECORD"),
        (("997", "0.0", "0.0", "OBS", "not-a-date"), "INVALID_EVENT_DATE"),
        (("1", "0", "0", "OBS", "2020-06"), "INVALID_EVENT_DATE"),
        (("1", "0", "0", "OBS", ""), None),
        (("999001", "-34.0", "18.5", "HUMAN_OBSERVATION", "2020-06-15"), None),
        (("12x", "0", "0", "OBS", None), "HTTP_ERROR"),
    ]
    rows = [("sk", i, *c, "US", "VU", None) for i, (c, _) in enumerate(cases)]
    df = spark.createDataFrame(rows, "species_key string, i int, gbifID string, "
                                     "decimalLatitude string, decimalLongitude string, "
                                     "basisOfRecord string, eventDate string, country string, "
                                     "iucnRedListCategory string, coordinateUncertaintyInMeters string")
    got = {r.i: r for r in VAL.validate_occurrences(df).collect()}
    for i, (_, expected) in enumerate(cases):
        assert got[i][R.REASON] == expected, (i, got[i][R.REASON])
    assert got[5].decimal_latitude == -90.0 and got[9].event_date is None
    q = R.quarantine_rows(VAL.validate_occurrences(df), "gbif_occurrence", "b1", "gbifID")
    assert q.count() == 9
    assert {r.record_key for r in q.collect()} >= {"None", "999", "998"}


def test_no_silent_loss(spark):
    df = spark.createDataFrame([(1, 404, None), (2, 200, '{"matchType": "EXACT"}')],
                               "k int, status int, data string")
    checked = VAL.validate_taxonomy(df, key="k")
    row = R.outcome_counts(df, checked, "t").first()
    assert (row.n_input, row.n_valid, row.n_rejected, row.balanced) == (2, 1, 1, True)
    lost = R.outcome_counts(df, R.valid(checked), "t").first()
    assert (lost.n_input, lost.balanced) == (2, False)

