"""Whole batch from landed JSON envelopes: silver, quarantine, merge, warehouse, gold,
idempotent rerun, second batch, empty batch, text search (FIXTURES 2.2-2.8)."""

import json
import os

import pytest

from lodestone.plans.batch_run import run_batch, search_text
from lodestone.sources.bronze import batch_names
from lodestone.sources.store import TableStore

from .conftest import SF001

SECTIONS = ("== Description ==\nLarge predatory shark.\n== Distribution and habitat ==\n"
            "Coastal waters worldwide.\n== Diet ==\nSeals and fish.\n== Etymology ==\nGreek.")


def envelope(source, queried, responses):
    return {"source": source, "lote": 1, "ingested_at": "2024-01-01T00:00:00Z",
            "species_queried": [queried],
            "raw_responses": [{"query": q, "response": {"status": s, "data": d}}
                              for q, s, d in responses]}


def land(root, batch_id, species):
    """Write envelopes the way the landing writer lays them out (JSON lines); pages are
    queried under their title."""
    for source in ("wikipedia", "gbif_taxonomy", "gbif_occurrence"):
        os.makedirs(f"{root}/source={source}/batch_id={batch_id}", exist_ok=True)
    files = {s: open(f"{root}/source={s}/batch_id={batch_id}/part-0.json", "w")
             for s in ("wikipedia", "gbif_taxonomy", "gbif_occurrence")}
    for name, title, page_ok, match, occs in species:
        summary = ({"title": title, "extract": "x" * 60, "type": "standard",
                    "content_urls": {"desktop": {"page": "https://w/" + title}}}
                   if page_ok else None)
        files["wikipedia"].write(json.dumps(envelope("wikipedia", title, [
            (f"summary:{title}", 200 if page_ok else 404, summary),
            (f"extracts:{title}", 200, {"query": {"pages": {"1": {"extract": SECTIONS}}}})])) + "\n")
        tax = {"usageKey": 1, "scientificName": name, "canonicalName": name, "rank": "SPECIES",
               "matchType": match, "confidence": 99, "kingdom": "Animalia", "phylum": "Chordata",
               "class": "Chondrichthyes"}
        files["gbif_taxonomy"].write(json.dumps(envelope("gbif_taxonomy", name,
                                                         [(name, 200, tax)])) + "\n")
        files["gbif_occurrence"].write(json.dumps(envelope("gbif_occurrence", name, [
            (name, 200, {"results": occs})])) + "\n")
    for f in files.values():
        f.close()


def occ(i, country, date, cat, lat="1.0"):
    return {"gbifID": str(i), "decimalLatitude": lat, "decimalLongitude": "2.0",
            "country": country, "eventDate": date, "basisOfRecord": "HUMAN_OBSERVATION",
            "iucnRedListCategory": cat}


def test_batch_end_to_end(spark, tmp_path):
    bronze, wh = str(tmp_path / "bronze"), str(tmp_path / "wh")
    land(bronze, "b1", [
        ("Carcharodon carcharias", "Great white shark", True, "EXACT",
         [occ(1, "US", "2020-06-15", "VU"), occ(2, "ZA", "2019", "VU"), occ(3, "ZA", "bad", "NT"),
          occ(4, "ZA", "2021-08-22", "NT", lat="999")]),
        ("Rhincodon typus", "Whale shark", True, "FUZZY", []),
        ("Nothing here", "Nothing", False, "EXACT", [occ(5, "US", "", "LC")]),
    ])
    names = batch_names(spark, text="Carcharodon carcharias, Rhincodon typus, Nothing here")
    resolution = spark.createDataFrame(
        [("Carcharodon carcharias", "Great white shark"), ("Rhincodon typus", "Whale shark"), ("Nothing here", "Nothing")],
        "name string, title string").selectExpr("*", "'SUCCESS' as status", "'REDIRECT' as resolved_via",
                                                "cast(null as array<string>) as candidates")
    seed = spark.createDataFrame([("Carcharodon carcharias",)], "name string")
    r1 = run_batch(spark, names, bronze, wh, "b1", seed=seed, resolution=resolution)
    s = r1.summary
    assert s["silver"]["wikipedia_valid"] == 2 and s["silver"]["wikipedia_rejected"] == 1
    assert s["silver"]["gbif_taxonomy_valid"] == 2 and s["silver"]["gbif_taxonomy_rejected"] == 1
    assert s["silver"]["gbif_occurrence_valid"] == 3 and s["silver"]["gbif_occurrence_rejected"] == 2
    assert s["merge"] == {"merged": 2, "skipped_no_wikipedia": 1}
    st = TableStore(spark, wh)
    merged = {r.species_key: r for r in st.read("species_merged").collect()}
    gw = merged["carcharodon_carcharias"]
    assert gw.taxonomy_status == "MATCHED" and gw.n_occurrences_validas == 2
    assert gw.paises == ["US", "ZA"] and (gw.anio_min, gw.anio_max) == (2019, 2020)
    assert merged["rhincodon_typus"].taxonomy_status == "UNMATCHED"
    assert merged["rhincodon_typus"].augmentation_status == "GBIF_AUGMENTATION_EMPTY"
    q = spark.read.parquet(f"{wh}/quarantine").collect()
    reasons = {(r.source, r.rejection_reason) for r in q}
    assert ("wikipedia", "PAGE_NOT_FOUND") in reasons
    assert ("gbif_occurrence", "INVALID_EVENT_DATE") in reasons
    assert ("gbif_occurrence", "COORDINATES_OUT_OF_RANGE") in reasons
    cat = {r.species_key: r for r in st.read("species_catalog").collect()}
    assert cat["carcharodon_carcharias"].origin == "SEED" and cat["rhincodon_typus"].origin == "AD_HOC"
    gold = st.read("chunk_vectors")
    ids = {r.chunk_id for r in gold.collect()}
    assert "carcharodon_carcharias__Identity__0" in ids and "carcharodon_carcharias__Diet__0" in ids
    assert "carcharodon_carcharias__Habitat__0" not in ids
    assert s["gold"]["n_chunks"] == len(ids)

    # rerun of the same batch: nothing new anywhere, values unchanged
    r2 = run_batch(spark, names, bronze, wh, "b1", seed=seed, resolution=resolution)
    assert all(e["filas_nuevas"] == 0 for e in r2.summary["warehouse"])
    assert spark.read.parquet(f"{wh}/quarantine").count() == len(q)

    # a second batch adds keys and keeps the first batch's catalog values
    land(bronze, "b2", [("Carcharodon carcharias", "Great white shark (updated)", True, "EXACT", []),
                        ("Prionace glauca", "Blue shark", True, "EXACT", [occ(9, "PT", "2022", "NT")])])
    r3 = run_batch(spark, batch_names(spark, names=["Carcharodon carcharias", "Prionace glauca"]),
                   bronze, wh, "b2", seed=seed, resolution=spark.createDataFrame(
                       [("Carcharodon carcharias", "Great white shark (updated)"), ("Prionace glauca", "Blue shark")],
                       "name string, title string").selectExpr("*", "'SUCCESS' as status", "'SEARCH' as resolved_via",
                                                               "cast(null as array<string>) as candidates"))
    ev = {e["tabla"]: e for e in r3.summary["warehouse"]}
    assert ev["species_catalog"]["filas_nuevas"] == 1 and ev["species_catalog"]["filas_actualizadas"] == 1
    cat = {r.species_key: r for r in st.read("species_catalog").collect()}
    gw = cat["carcharodon_carcharias"]
    assert gw.wikipedia_title == "Great white shark (updated)" and gw.first_seen_batch_id == "b1"
    assert gw.last_processed_at >= gw.first_processed_at
    assert r3.summary["gold"]["n_species"] == 3  # gold covers the whole merged table
    # the incrementally maintained vectors equal a full rebuild
    from lodestone.operators import embed as EMB
    from lodestone.operators import sections as SEC
    rebuilt = EMB.embed(SEC.chunks(SEC.build_sections(st.read("species_merged"))),
                        "text", "embedding").drop("ord")
    cols = ["chunk_id", "species_key", "section", "text", "embedding"]
    have = sorted(tuple(r) for r in st.read("chunk_vectors").select(*cols).collect())
    want = sorted(tuple(r) for r in rebuilt.select(*cols).collect())
    assert have == want
    assert st.is_bucketed("silver_gbif_occurrences")

    from lodestone.operators import quality as QC
    checks = QC.run_checks([
        QC.subset_check("gold within catalog", st.read("chunk_vectors"), st.read("species_catalog"),
                        "species_key"),
        QC.subset_check("merged within catalog", st.read("species_merged"),
                        st.read("species_catalog"), "species_key"),
        QC.unique_check("catalog keyed", st.read("species_catalog"), "species_key"),
        QC.unique_check("occurrences keyed", st.read("silver_gbif_occurrences"), "gbif_id"),
    ]).collect()
    assert all(c.passed for c in checks) and len(checks) == 4

    hits = search_text(spark, wh, spark.createDataFrame(
        [("q1", "seals fish diet"), ("q2", "")], "query_id string, text string"), top_k=5).collect()
    assert {h.query_id for h in hits} == {"q1"}
    assert len({h.species_key for h in hits}) == len(hits) <= 3
    only = search_text(spark, wh, spark.createDataFrame([("q", "shark")], "query_id string, text string"),
                       top_k=5, country="PT").collect()
    assert [h.species_key for h in only] in ([], ["prionace_glauca"])


def test_empty_batch(spark, tmp_path):
    r = run_batch(spark, batch_names(spark, names=[]), str(tmp_path / "b"), str(tmp_path / "w"))
    assert r.summary == {"status": "empty_batch", "message": "No species provided"}
    assert not os.path.exists(tmp_path / "w")


def test_store_introspection_lookup_and_json_round_trip(spark, tmp_path):
    from lodestone.functions import record_from_json, record_to_json
    from lodestone.sources.bronze import split_batches
    from lodestone.sources.store import TableStore
    store = TableStore(spark, str(tmp_path / "wh"))
    df = spark.createDataFrame([("a", 1, ["x", "y"]), ("b", 2, [])], "k string, n int, l array<string>")
    store.write("t", df)
    assert store.tables() == ["t"]
    assert [tuple(r) for r in store.describe("t").collect()] == [("k", "string"), ("n", "int"),
                                                                 ("l", "array<string>")]
    assert [r.n for r in store.lookup("t", "k", "b").collect()] == [2]
    js = df.select(record_to_json("*").alias("j"))
    back = js.select(record_from_json("j", df.schema).alias("r")).select("r.*")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    names = spark.createDataFrame([(f"n{i:02d}", i) for i in range(18)], "name string, o int")
    halves = {r.name: r.batch_no for r in split_batches(names, "o", 2).collect()}
    assert halves["n00"] == 1 and halves["n08"] == 1 and halves["n09"] == 2 and halves["n17"] == 2


def test_resolution_rejects(spark, tmp_path):
    from lodestone.operators import validate as VAL
    from lodestone.sources.bronze import read_bronze, responses_of
    bronze, wh = str(tmp_path / "bronze"), str(tmp_path / "wh")
    land(bronze, "b1", [("Alpha one", "Alpha", True, "EXACT", [occ(i, "US", "2020", "LC") for i in range(1, 8)]),
                        ("Beta two", "Beta", True, "EXACT", [])])
    names = batch_names(spark, names=["Alpha one", "Beta two"])
    resolution = spark.createDataFrame(
        [("Alpha one", "SUCCESS", "SEARCH", "Alpha", None),
         ("Beta two", "AMBIGUOUS_RESOLUTION", None, None, ["Beta (a)", "Beta (b)"])],
        "name string, status string, resolved_via string, title string, candidates array<string>")
    r = run_batch(spark, names, bronze, wh, "b1", resolution=resolution)
    assert r.summary["merge"] == {"merged": 1, "skipped_no_wikipedia": 1}
    assert r.summary["silver"]["wikipedia_rejected"] == 1
    q = [x for x in spark.read.parquet(f"{wh}/quarantine").collect() if x.source == "wikipedia"]
    assert [(x.record_key, x.rejection_reason) for x in q] == [("beta_two", "AMBIGUOUS_RESOLUTION")]
    assert q[0].context["candidates"] == "Beta (a)|Beta (b)"
    page = TableStore(spark, wh).read("silver_wikipedia").first()
    assert (page.species_key, page.resolved_via) == ("alpha_one", "SEARCH")
    resp = responses_of(read_bronze(spark, bronze)).where("source = 'gbif_occurrence'")
    assert VAL.occurrence_records(resp).count() == 7


def test_one_outcome_per_name_latest_fetch_and_stale_quarantine(spark, tmp_path):
    """A refetch (500, then 200) counts once; a name without a page, a failed occurrence
    response and a corrupt line are in quarantine, and leave it when a rerun mends them."""
    bronze, wh = str(tmp_path / "bronze"), str(tmp_path / "wh")
    land(bronze, "b1", [("Alpha one", "Alpha", True, "EXACT", [])])
    page = f"{bronze}/source=wikipedia/batch_id=b1"
    failed = envelope("wikipedia", "Alpha", [("summary:Alpha", 500, None)])
    failed["ingested_at"] = "2023-12-31T00:00:00Z"
    with open(f"{page}/part-1.json", "w") as f:
        f.write(json.dumps(failed) + "\n{broken\n")
    with open(f"{bronze}/source=gbif_occurrence/batch_id=b1/part-1.json", "w") as f:
        late = envelope("gbif_occurrence", "Alpha one", [("Alpha one", 503, None)])
        late["ingested_at"] = "2024-01-02T00:00:00Z"
        f.write(json.dumps(late) + "\n")
    resolution = spark.createDataFrame([("Alpha one", "Alpha"), ("Gamma", "Gamma page")], "name string, title string").selectExpr(
        "*", "'SUCCESS' as status", "'SEARCH' as resolved_via", "cast(null as array<string>) as candidates")
    names = batch_names(spark, names=["Alpha one", "Gamma"])
    r = run_batch(spark, names, bronze, wh, "b1", resolution=resolution)
    assert r.summary["merge"] == {"merged": 1, "skipped_no_wikipedia": 1}
    got = {(q.source, q.rejection_reason, q.record_key) for q in spark.read.parquet(f"{wh}/quarantine").collect()}
    assert got == {("wikipedia", "PAGE_NOT_FOUND", "gamma"), ("gbif_occurrence", "HTTP_ERROR", "alpha_one"),
                   ("bronze", "HTTP_ERROR", "{broken")}
    # an occurrence table that began without rows takes the next batch
    land(bronze, "b2", [("Alpha one", "Alpha", True, "EXACT", [occ(1, "US", "2020", "LC")])])
    run_batch(spark, batch_names(spark, names=["Alpha one"]), bronze, wh, "b2", resolution=resolution)
    st = TableStore(spark, wh)
    assert st.read("silver_gbif_occurrences").count() == 1
    assert st.lookup("silver_gbif_occurrences", "gbif_id", 1).count() == 1
    # everything mended: nothing of the batch stays in quarantine
    os.remove(f"{bronze}/source=gbif_occurrence/batch_id=b1/part-1.json")
    with open(f"{page}/part-1.json", "w") as f:
        f.write(json.dumps(failed) + "\n")
    run_batch(spark, batch_names(spark, names=["Alpha one"]), bronze, wh, "b1", resolution=resolution)
    assert spark.read.parquet(f"{wh}/quarantine").where("batch_id = 'b1'").count() == 0


def test_reference_layout_and_exact_text(spark, tmp_path):
    from lodestone.sources import bronze as B
    os.makedirs(tmp_path / "wikipedia")
    env = envelope("wikipedia", "T", [("extracts:T", 200, {"9": {"n": 1.0}, "10": {}}), ("summary:T", 200, "plain")])
    with open(tmp_path / "wikipedia" / "lote_1.json", "w") as f:
        json.dump(env, f, indent=2)
    rows = {r.query: r for r in B.responses_of(B.read_envelope_files(spark, str(tmp_path))).collect()}
    assert list(json.loads(rows["extracts:T"].data)) == ["9", "10"] and "1.0" in rows["extracts:T"].data
    assert rows["summary:T"].data == "plain" and rows["summary:T"].batch_id == "lote_1"
    text = '{"9":{"x":1.0},  "10":[]}'
    one = spark.createDataFrame([("q", 200, text), ("r", 200, None)], "query string, status int, data string")
    B.write_bronze(B.envelopes(one, "s"), str(tmp_path / "own"), "b")
    back = {r.query: r.data for r in B.responses_of(B.read_bronze(spark, str(tmp_path / "own"))).collect()}
    assert back == {"q": text, "r": None}
    assert [r.name for r in batch_names(spark, text="\ta b\n,,c ").collect()] == ["a b", "c"]


def test_split_batches_with_remainder(spark):
    from lodestone.sources.bronze import split_batches
    names = spark.createDataFrame([(f"n{i:02d}", i) for i in range(7)], "name string, o int")
    got = {r.name: r.batch_no for r in split_batches(names, "o", 2).collect()}
    assert [got[f"n{i:02d}"] for i in range(7)] == [1, 1, 1, 1, 2, 2, 2]
    three = {r.name: r.batch_no for r in split_batches(names, "o", 3).collect()}
    assert [three[f"n{i:02d}"] for i in range(7)] == [1, 1, 1, 2, 2, 2, 3]


def test_landed_bodies_are_dealt_once(spark, tmp_path):
    """Pages are grouped once, by title; the checked rows are written without the landed bodies."""
    from pyspark.sql import functions as F

    from lodestone.operators import rules as R
    from lodestone.plans import batch_run as BR
    from lodestone.sources import bronze as B
    text = "a page about nothing much that is long enough to be kept " * 2
    summary, extracts = json.dumps({"title": "T", "extract": text}), json.dumps({"query": {"pages": {"1": {"title": "T", "extract": text}}}})
    rows = [("A b", "summary:A b", 500, None), ("A b", "summary:A b", 200, summary), ("A b", "extracts:A b", 200, extracts)]
    for day, part in (("01", rows[:1]), ("02", rows[1:])):
        env = B.envelopes(spark.createDataFrame(part, "title string, query string, status int, data string"), "wikipedia",
                          group_col="title", queried_col="title")
        B.write_bronze(env.withColumn("ingested_at", F.lit(f"2024-01-{day}T00:00:00Z")), str(tmp_path), "b1")
    names = spark.createDataFrame([("A b",), ("C d",)], "name string")
    fr = BR.silver_frames(spark, names, str(tmp_path), "b1")
    plan = fr["pages"]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("max_by(") == 2 and "Aggregate" not in fr["taxonomy"]._jdf.queryExecution().optimizedPlan().toString()
    pages, tax, occ = BR.checked_rows(fr)
    assert not {"summary_data", "extracts_data", "data"} & {*pages.columns, *tax.columns, *occ.columns}
    got = pages.select("species_key", "batch_id", "title_q", R.REASON, "sections_text").collect()
    assert [tuple(r) for r in got] == [("a_b", "b1", "A b", None, text)] and not tax.count() and not occ.count()
    assert [tuple(r) for r in fr["other_rejects"].select("record_key", R.REASON).collect()] == [("c_d", R.PAGE_NOT_FOUND)]


def _tables(spark):
    from lodestone.session import checkpoint_dir
    where = f"{checkpoint_dir(spark)}/tables"
    return {*os.listdir(where)} if os.path.exists(where) else set()


def test_a_run_leaves_the_warehouse_alone_on_disk(spark, tmp_path):
    """no intermediate table and no superseded version outlives the run, and each goes
    after its last reader."""
    from lodestone.plans import batch_run as BR
    bronze, wh = str(tmp_path / "bronze"), str(tmp_path / "wh")
    land(bronze, "b1", [("Alpha one", "Alpha", True, "EXACT", [occ(1, "US", "2020", "LC"), occ(2, "US", "bad", "LC")]),
                        ("Beta two", "Beta", False, "EXACT", [])])
    resolution = spark.createDataFrame([("Alpha one", "Alpha"), ("Beta two", "Beta")], "name string, title string").selectExpr(
        "*", "'SUCCESS' as status", "'SEARCH' as resolved_via", "cast(null as array<string>) as candidates")
    before, most = _tables(spark), []
    real = BR.EMB.embed

    def watched(*args):
        most.append(len(_tables(spark) - before))
        return real(*args)

    BR.EMB.embed = watched
    try:
        for _ in (1, 2):
            run = run_batch(spark, batch_names(spark, names=["Alpha one", "Beta two"]), bronze, wh, "b1", resolution=resolution)
    finally:
        BR.EMB.embed = real
    assert _tables(spark) == before and max(most) <= 3  # merged rows, rejects, parents
    st = TableStore(spark, wh)
    for table in st.tables():
        assert sum(n.startswith("v=") for n in os.listdir(f"{wh}/{table}")) == 1, table
    assert sorted((r.source, r.record_key) for r in run.quarantine.collect()) == [
        ("gbif_occurrence", "2"), ("wikipedia", "beta_two")]
    page, merged = st.read("silver_wikipedia").first(), st.read("species_merged").first()
    assert page.extract == merged.extract == "x" * 60 and page.sections_text == merged.sections_text == SECTIONS


def test_landed_lines_are_compressed_and_dealt(spark, tmp_path, monkeypatch):
    """landed files are compressed, and short enough for a task each."""
    from lodestone.sources import bronze as B
    monkeypatch.setattr(B, "LINES_PER_FILE", 40)
    rows = spark.range(100).selectExpr("concat('q', id) as query", "200 as status", "repeat('a body ', 500) as data").coalesce(1)
    B.write_bronze(B.envelopes(rows, "s"), str(tmp_path), "b1")
    files = [f for f in (tmp_path / "source=s" / "batch_id=b1").iterdir() if f.name.startswith("part-")]
    assert len(files) == 3 and all(f.name.endswith(".json.gz") for f in files)
    assert sum(f.stat().st_size for f in files) < 20_000
    back = B.responses_of(B.read_bronze(spark, str(tmp_path))).collect()
    assert sorted(r.query for r in back) == sorted(f"q{i}" for i in range(100)) and {r.data for r in back} == {"a body " * 500}


def test_latest_fetch_is_dealt_once(spark, tmp_path):
    """a response's body is in the exchange once, not beside itself as what orders it."""
    from lodestone.sources import bronze as B
    rows = spark.createDataFrame(
        [("q", 1, 500, "zz"), ("q", 2, 200, "a"), ("q", 2, 200, "b"), ("r", 1, None, None)], "query string, fetch int, status int, data string")
    latest = B.latest_fetch(rows.selectExpr("*", "'s' as source", "'b' as batch_id"))
    assert sorted(tuple(r) for r in latest.select("query", "fetch", "status", "data").collect()) == [("q", 2, 200, "b"), ("r", 1, None, None)]
    assert "max_by(" not in latest._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["batch_quarantine", "batch_warehouse", "batch_summary", "batch_determinism"])
def test_a_batch_query_leaves_its_warehouses_alone(spark, name):
    """F1 to F4: neither the landing nor an intermediate table outlives the runs."""
    from lodestone.plans.queries import REGISTRY
    from lodestone.session import checkpoint_dir
    where = checkpoint_dir(spark)
    tables, landings = _tables(spark), {n for n in os.listdir(where) if n.startswith("batch-")}
    assert REGISTRY[name](spark, SF001).count()
    assert _tables(spark) == tables and {n for n in os.listdir(where) if n.startswith("batch-")} == landings
