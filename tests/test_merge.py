"""Observation summary and pivot merge (FIXTURES 2.5)."""

import datetime as dt


from lodestone.operators import merge as M
from lodestone.operators import summarize as S

OCC = "k string, pos int, country string, event_date timestamp, cat string"


def d(y, m=1, day=1):
    return dt.datetime(y, m, day)


def summary(spark, rows):
    df = spark.createDataFrame(rows, OCC)
    return {r.k: r for r in S.summarize_observations(df, "k", "pos", "country", "cat",
                                                      "event_date").collect()}


def test_summary_fixture(spark):
    rows = [("s", 0, "United States", d(2020, 6, 15), "VULNERABLE"),
            ("s", 1, "South Africa", d(2019, 3, 10), "VULNERABLE"),
            ("s", 2, "South Africa", d(2021, 8, 22), "NEAR_THREATENED"),
            ("s", 3, "United States", d(2015, 1, 5), "VULNERABLE")]
    r = summary(spark, rows)["s"]
    assert r.n_occurrences_validas == 4
    assert r.paises == ["United States", "South Africa"]  # tie -> first seen
    assert (r.anio_min, r.anio_max) == (2015, 2021)
    assert r.iucn_red_list_category == "VULNERABLE"


def test_mode_ties(spark):
    rows = [("a", 0, None, d(2020), "VULNERABLE"), ("a", 1, None, d(2021), "NEAR_THREATENED"),
            ("b", 0, None, None, "VULNERABLE"), ("b", 1, None, d(2001), "NEAR_THREATENED"),
            ("c", 0, "", None, "X"), ("c", 1, "", None, "Y"),
            ("d", 0, None, None, None)]
    got = summary(spark, rows)
    assert got["a"].iucn_red_list_category == "NEAR_THREATENED"  # latest date
    assert got["b"].iucn_red_list_category == "NEAR_THREATENED"  # missing date loses
    assert got["c"].iucn_red_list_category == "X"                # then first seen
    assert got["c"].paises == [] and got["c"].anio_min is None
    assert got["d"].iucn_red_list_category is None and got["d"].n_occurrences_validas == 1


def test_hot_key_is_exact(spark):
    # one key holds most rows: partial aggregation must still give exact results
    rows = [("hot", i, f"C{i % 3}", d(2000 + i % 20), f"K{i % 2}") for i in range(3000)]
    rows += [("cold", 0, "C9", d(1999), "K9")]
    got = summary(spark, rows)
    assert got["hot"].n_occurrences_validas == 3000
    assert got["hot"].paises == ["C0", "C1", "C2"]
    assert got["hot"].iucn_red_list_category == "K1"  # count tie -> latest year 2019
    assert got["cold"].paises == ["C9"]


def test_pivot_merge(spark):
    pivot = spark.createDataFrame([("s1", "Great white shark"), ("s2", "T2"), ("s3", "T3")],
                                  "species_key string, wikipedia_title string")
    tax = spark.createDataFrame(
        [("s1", "EXACT", "Animalia", "Chordata", "Chondrichthyes", "SPECIES"),
         ("s2", "FUZZY", "Animalia", "Chordata", None, "SPECIES"),
         ("s9", "EXACT", "Plantae", None, None, None)],
        "species_key string, match_type string, kingdom string, phylum string, "
        "class_name string, rank string")
    occ = spark.createDataFrame([("s1", 0, "US", d(2020), "VU"), ("s9", 0, "US", d(2020), "VU")], OCC)
    summ = S.summarize_observations(occ.withColumnRenamed("k", "species_key"), "species_key",
                                    "pos", "country", "cat", "event_date")
    got = {r.species_key: r for r in M.pivot_merge(pivot, "species_key", tax, summ).collect()}
    assert set(got) == {"s1", "s2", "s3"}  # augmentation never adds a key
    assert got["s1"].taxonomy_status == "MATCHED" and got["s1"].class_name == "Chondrichthyes"
    assert got["s2"].taxonomy_status == "UNMATCHED" and got["s2"].kingdom is None
    assert got["s3"].n_occurrences_validas == 0 and got["s3"].paises == []
    assert got["s3"].augmentation_status == "GBIF_AUGMENTATION_EMPTY"
    assert got["s1"].augmentation_status == "OK"
    um = M.unmatched_pivot(tax, pivot, "species_key", "species_key").collect()
    assert [r.species_key for r in um] == ["s9"]
