"""One batch end to end: bronze -> silver (+ quarantine) -> merge -> warehouse -> gold.

Every stage is a DataFrame plan; actions happen only where results are
written (silver / quarantine / warehouse / gold tables) and for the small run
summary.  Keys: ``species_key = slugify(name)``; occurrences are keyed by id.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import non_null_map, slugify
from ..operators import embed as EMB
from ..operators import merge as M
from ..operators import rules as R
from ..operators import search as K
from ..operators import sections as SEC
from ..operators import summarize as S
from ..operators import validate as VAL
from ..session import Scratch, cut_lineage
from ..sources import bronze as B
from ..sources.store import TableStore

# The columns of the tables, in their order.
PAGE_COLUMNS = ["species_key", "title", "resolved_via", "extract", "sections_text", "page_url",
                "is_disambiguation"]
TAXONOMY_COLUMNS = ["species_key", "usage_key", "scientific_name", "canonical_name", "rank",
                    "match_type", "confidence", "kingdom", "phylum", "class_name"]
OCCURRENCE_COLUMNS = ["gbif_id", "species_key", "decimal_latitude", "decimal_longitude", "country",
                      "event_date", "basis_of_record", "iucn_red_list_category",
                      "coordinate_uncertainty_m"]
MERGED_COLUMNS = ["species_key", "wikipedia_title", "extract", "sections_text", "kingdom", "phylum",
                  "class_name", "rank", "taxonomy_status", "n_occurrences_validas", "paises",
                  "anio_min", "anio_max", "iucn_red_list_category", "augmentation_status",
                  "updated_at"]
CATALOG_COLUMNS = ["species_key", "scientific_name", "wikipedia_title", "first_seen_batch_id",
                   "first_processed_at", "last_processed_at", "origin"]
CATALOG_INSERT_ONLY = ["scientific_name", "first_seen_batch_id", "first_processed_at", "origin"]
# Long texts of a page, joined to other columns only where they are written.
BODY_COLUMNS = ["extract", "sections_text"]
WAREHOUSE_TABLES = ["silver_wikipedia", "silver_gbif_taxonomy", "silver_gbif_occurrences",
                    "species_merged", "species_catalog"]
# Resolution statuses that send a name to quarantine.
REJECTED_RESOLUTION = ("PAGE_NOT_FOUND", "AMBIGUOUS_RESOLUTION", "DISAMBIGUATION_PAGE")
# Metadata a search hit carries.
METADATA_FIELDS = ("kingdom", "phylum", "class_name", "rank", "taxonomy_status",
                   "iucn_red_list_category", "paises", "anio_min", "anio_max",
                   "n_occurrences_validas", "augmentation_status")

METADATA_TYPES = ("string",) * 6 + ("array<string>", "int", "int", "int", "string")


@dataclass
class BatchRun:
    summary: dict
    evidence: DataFrame | None = None
    quarantine: DataFrame | None = None
    extra: dict = field(default_factory=dict)


def _counts(df: DataFrame, by: str) -> dict:
    return {r[0]: r[1] for r in df.groupBy(by).count().collect()}  # a handful of groups


def checked_rows(frames: dict[str, DataFrame], keep: Callable[[DataFrame], DataFrame] = cut_lineage
                 ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The checked pages, taxonomy and occurrences, each parsed once and written (by ``keep``)
    without the landed bodies and the texts of rejected pages, which nothing reads any more."""
    frames = {**frames, "pages": frames["pages"].withColumns(
        {c: F.when(F.col(R.REASON).isNull(), F.col(c)) for c in BODY_COLUMNS})}
    return tuple(keep(frames[k].drop("summary_data", "extracts_data", "data")) for k in ("pages", "taxonomy", "occurrences"))


def silver_frames(spark: SparkSession, names: DataFrame, bronze_root: str, batch_id: str,
                  resolution: DataFrame | None = None,
                  keep: Callable[[DataFrame], DataFrame] = cut_lineage) -> dict[str, DataFrame]:
    """Checked silver rows (with ``rejection_reason``) of the three sources of one batch, and the
    tables written by ``keep`` that they are read from (``envelopes``, ``responses``)."""
    keys = names.select(slugify("name").alias("species_key"), "name").dropDuplicates(["species_key"])
    env = keep(B.read_bronze(spark, bronze_root).where(F.col("batch_id") == batch_id))
    # of several fetches of one query the latest counts, for all sources; pages are paired by
    # title and their latest fetch of either kind is taken with it, in one exchange
    responses = B.responses_of(env)
    landed = B.latest_fetch(responses.where(F.col("source") != "wikipedia").select(
        "source", "batch_id", "query", "queried", "status", "data", "fetch"))
    # the title a name's page was fetched under: the resolved one, else the name itself
    titled = keys.withColumn("title_q", F.col("name")).withColumn("resolution_via", F.lit(None).cast("string"))
    blocked = None
    if resolution is not None:
        res = resolution.select(slugify("name").alias("species_key"), F.col("status").alias("_status"),
                                F.col("resolved_via").alias("_via"), F.col("candidates").alias("_cands"),
                                (F.col("title") if "title" in resolution.columns else
                                 F.lit(None).cast("string")).alias("_title")).dropDuplicates(["species_key"])
        joined = keys.join(res, "species_key", "left")
        rejected = F.coalesce(F.col("_status").isin(*REJECTED_RESOLUTION), F.lit(False))
        blocked = joined.where(rejected)
        keys = joined.where(~rejected).select("species_key", "name")
        titled = joined.where(~rejected).select("species_key", F.coalesce("_title", "name").alias("title_q"),
                                                F.col("_via").alias("resolution_via"))
    paired = B.pair_page_responses(responses.where(F.col("source") == "wikipedia"), by=()).withColumn(
        "batch_id", F.lit(batch_id))
    # bodies of pages never go through the driver, however few: no broadcast
    pages = titled.select("species_key", "title_q", "resolution_via").join(paired.hint("merge"), "title_q", "left")
    # a name for which no page was landed is an outcome too
    missing = F.col("batch_id").isNull()
    unlanded = pages.where(missing)
    pages = VAL.validate_pages(pages.where(~missing), key="species_key", resolved_via=F.col("resolution_via"))
    # written: taxonomy, occurrences and rejects read it
    resp = keep(landed.withColumn("species_key", slugify("queried")).join(
        keys.select("species_key"), "species_key", "left_semi"))
    tax = VAL.validate_taxonomy(resp.where(F.col("source") == "gbif_taxonomy"), key="species_key")
    occ_resp = resp.where(F.col("source") == "gbif_occurrence")
    status = F.coalesce(F.col("status"), F.lit(200))
    occ = VAL.validate_occurrences(VAL.occurrence_records(occ_resp.where(status == 200)), key="species_key")

    def reject(df: DataFrame, origin: str, reason, key: str = "species_key", /, **details) -> DataFrame:
        return df.select(F.lit(origin).alias("source"), F.lit(batch_id).alias("batch_id"),
                         F.col(key).alias("record_key"), reason.alias(R.REASON),
                         non_null_map(*details.items()).alias(R.CONTEXT))

    other = [reject(unlanded, "wikipedia", F.lit(R.PAGE_NOT_FOUND), species_key="species_key", title="title_q"),
             reject(occ_resp.where(status != 200), "gbif_occurrence", F.lit(R.HTTP_ERROR),
                    species_key="species_key", http_status="status"),
             reject(B.corrupt_lines(env).withColumn("line", R.line_key("record")), "bronze",
                    F.lit(R.HTTP_ERROR), "line", source="source", line="record", file="file")]
    if blocked is not None:
        other.append(reject(blocked.withColumn("_c", F.array_join("_cands", "|")), "wikipedia", F.col("_status"),
                            species_key="species_key", scientific_name="name", title="_title",
                            resolution_status="_status", candidates="_c"))
    rest = other[0]
    for o in other[1:]:
        rest = rest.unionByName(o)
    return {"pages": pages, "taxonomy": tax, "occurrences": occ, "other_rejects": rest,
            "envelopes": env, "responses": resp}


def merged_frame(pages: DataFrame, tax: DataFrame, occ: DataFrame) -> DataFrame:
    """Merged record per valid page: gated taxonomy + occurrence summary."""
    summary = S.summarize_observations(occ, "species_key", "pos", "country",
                                       "iucn_red_list_category", "event_date")
    pivot = pages.select("species_key", F.col("title").alias("wikipedia_title"), "extract",
                         "sections_text")
    merged = M.pivot_merge(pivot, "species_key", tax, summary)
    return merged.withColumn("updated_at", F.current_timestamp()).select(*MERGED_COLUMNS)


def run_batch(spark: SparkSession, names: DataFrame, bronze_root: str, warehouse_root: str,
              batch_id: str | None = None, seed: DataFrame | None = None,
              resolution: DataFrame | None = None,
              encoder=None, occurrence_buckets: int | None = None,
              full_gold_rebuild: bool = False) -> BatchRun:
    """Process one batch; returns the run summary, the upsert evidence and the batch's rows in
    the quarantine table (until a later run of the batch replaces them)."""
    if names.isEmpty():
        return BatchRun({"status": "empty_batch", "message": "No species provided"})
    batch_id = batch_id or "batch_" + datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S")
    store = TableStore(spark, warehouse_root)
    # the run holds on disk what a later step reads: every table goes after its last reader
    with Scratch(spark) as scratch:
        return _run_steps(spark, store, scratch, names, bronze_root, batch_id, seed, resolution, encoder,
                          occurrence_buckets, full_gold_rebuild)


def _run_steps(spark: SparkSession, store: TableStore, scratch: Scratch, names: DataFrame, bronze_root: str,
               batch_id: str, seed: DataFrame | None, resolution: DataFrame | None, encoder,
               occurrence_buckets: int | None, full_gold_rebuild: bool) -> BatchRun:
    fr = silver_frames(spark, names, bronze_root, batch_id, resolution, scratch.keep)
    # each source is parsed and checked once; quarantine, silver, merge and the counts all
    # read the written rows (in the shared folder)
    pages, tax, occ = checked_rows(fr, scratch.keep)
    rest = scratch.keep(fr["other_rejects"])
    scratch.drop(fr["envelopes"], fr["responses"])

    # quarantine: the batch's rows replace all of its former ones, also where none are left
    quarantine = (R.quarantine_rows(pages, "wikipedia", batch_id, "species_key")
                  .unionByName(R.quarantine_rows(tax, "gbif_taxonomy", batch_id, "species_key"))
                  .unionByName(R.quarantine_rows(occ, "gbif_occurrence", batch_id, "gbifID"))
                  .unionByName(rest))
    store.write_partition("quarantine", quarantine, batch_id)
    store.vacuum("quarantine")
    page_counts, tax_counts, occ_counts = (_counts(df.withColumn("ok", F.col(R.REASON).isNull()), "ok")
                                           for df in (pages, tax, occ))
    other = _counts(rest, "source")

    ordered = F.struct("species_key", "fetch", "pos")
    valid_pages = R.valid(pages)
    valid_tax = R.valid(tax)
    valid_occ = R.valid(occ).withColumn("_order", ordered)
    bodies = valid_pages.select("species_key", *BODY_COLUMNS)  # a page a key
    evidence = []

    def upsert(table: str, *args, **options) -> None:
        evidence.append(store.upsert_bucketed(table, *args, **options))
        store.vacuum(table)

    upsert("silver_wikipedia", valid_pages.drop(*BODY_COLUMNS), "species_key", "title_q", PAGE_COLUMNS, wide=bodies)
    upsert("silver_gbif_taxonomy", valid_tax, "species_key", "fetch", TAXONOMY_COLUMNS)
    upsert("silver_gbif_occurrences", valid_occ, "gbif_id", "_order", OCCURRENCE_COLUMNS, buckets=occurrence_buckets)
    merged = scratch.keep(merged_frame(valid_pages, valid_tax, valid_occ).drop(*BODY_COLUMNS))
    scratch.drop(tax, occ)
    upsert("species_merged", merged, "species_key", "updated_at", MERGED_COLUMNS, wide=bodies)
    scratch.drop(pages)
    keys = names.select(slugify("name").alias("species_key"), "name").dropDuplicates(["species_key"])
    origin = F.lit("AD_HOC")
    cat = merged.select("species_key", "wikipedia_title").join(keys, "species_key")
    if seed is not None:
        cat = cat.join(seed.select(F.col("name").alias("_seed_name"), F.lit(True).alias("_seed")).distinct(),
                       F.col("name") == F.col("_seed_name"), "left")
        origin = F.when(F.col("_seed"), F.lit("SEED")).otherwise(F.lit("AD_HOC"))
    now = F.current_timestamp()
    cat = cat.select("species_key", F.col("name").alias("scientific_name"), "wikipedia_title",
                     F.lit(batch_id).alias("first_seen_batch_id"), now.alias("first_processed_at"),
                     now.alias("last_processed_at"), origin.alias("origin"))
    upsert("species_catalog", cat, "species_key", "last_processed_at", CATALOG_COLUMNS, CATALOG_INSERT_ONLY)
    ev = evidence[0]
    for e in evidence[1:]:
        ev = ev.unionByName(e)

    # gold: the vector table always equals a rebuild from the whole merged table.  Only the
    # species merged in this batch are re-chunked and re-embedded (the encoder is
    # deterministic), and only their buckets are rewritten.
    all_merged = store.read("species_merged")
    if full_gold_rebuild or not store.exists("chunk_vectors"):
        parents, gone = scratch.keep(SEC.build_sections(all_merged)), None
    else:
        gone = merged.select("species_key")
        parents = scratch.keep(SEC.build_sections(all_merged.join(gone, "species_key", "left_semi")))
    store.replace_keys("gold_species", parents, "species_key")
    store.vacuum("gold_species")
    store.replace_keys("chunk_vectors", EMB.embed(SEC.chunks(parents), "text", "embedding", encoder).drop("ord"),
                       "species_key", gone=gone)
    for table in store.tables():
        store.vacuum(table)
    gold_counts = {t: store.read(t).count() for t in ("species_merged", "chunk_vectors")}

    n_names, n_merged = keys.count(), merged.count()
    summary = {
        "batch_id": batch_id, "n_species": n_names,
        "silver": {
            "wikipedia_valid": page_counts.get(True, 0),
            "wikipedia_rejected": page_counts.get(False, 0) + other.get("wikipedia", 0),
            "gbif_taxonomy_valid": tax_counts.get(True, 0),
            "gbif_taxonomy_rejected": tax_counts.get(False, 0),
            "gbif_occurrence_valid": occ_counts.get(True, 0),
            "gbif_occurrence_rejected": occ_counts.get(False, 0) + other.get("gbif_occurrence", 0),
            "bronze_corrupt": other.get("bronze", 0),
        },
        "merge": {"merged": n_merged, "skipped_no_wikipedia": n_names - n_merged},
        "warehouse": [r.asDict() for r in ev.collect()],  # five rows
        "gold": {"n_species": gold_counts["species_merged"], "n_chunks": gold_counts["chunk_vectors"],
                 "index_size": gold_counts["chunk_vectors"]},
    }
    in_store = store.read("quarantine").where(F.col("batch_id") == batch_id).select(*quarantine.columns)
    return BatchRun(summary, ev, in_store)


def search_text(spark: SparkSession, warehouse_root: str, queries: DataFrame, top_k: int = 5,
                mode: str = "pre", encoder=None, **filters) -> DataFrame:
    """Text queries ``(query_id, text)`` against the gold chunk vectors (K10).
    An empty query text gives no rows."""
    store = TableStore(spark, warehouse_root)
    if not store.exists("chunk_vectors"):
        kind = queries.schema["query_id"].dataType.simpleString()
        return spark.createDataFrame([], f"query_id {kind}, rank int, species_key string, wikipedia_title string, "
                                         "chunk_text string, score double, chunk_id string, metadata struct<"
                                     + ", ".join(f"{c}: {t}" for c, t in zip(METADATA_FIELDS, METADATA_TYPES)) + ">")
    q = EMB.embed(queries.where(F.coalesce(F.length("text"), F.lit(0)) > 0), "text", "query_vec",
                  encoder).select("query_id", "query_vec")
    meta = store.read("species_merged")
    return K.search(store.read("chunk_vectors"), q, meta, top_k, mode=mode,
                    metadata_fields=METADATA_FIELDS, **filters)
