"""Contract profiles for the three landed sources (page, taxonomy, occurrence).

Inputs keep the payloads as JSON *text* (or raw text fields), exactly as
landed; parsing happens here - object payloads once into a variant (absent and
null keys stay distinguishable), the page map with ``from_json`` (its JSON order
matters), numbers and dates with ``try_*`` functions - so dirty input becomes a
rejection reason and never an error.
Each function returns the input rows with typed columns, ``rejection_reason``
and ``context``; ``rules.valid`` / ``rules.rejected`` split them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import (date_of_parts, date_parts, first_map_value, is_falsy, is_nonempty_object,
                         safe_double)
from . import rules as R

EXTRACTS_SCHEMA = T.StructType([T.StructField("query", T.StructType([
    T.StructField("pages", T.MapType(T.StringType(), T.StructType([
        T.StructField("title", T.StringType()), T.StructField("extract", T.StringType())])))]))])
OCCURRENCE_FIELDS = ("gbifID", "decimalLatitude", "decimalLongitude", "country", "eventDate",
                     "basisOfRecord", "iucnRedListCategory", "coordinateUncertaintyInMeters")
OCCURRENCE_RESULTS_SCHEMA = T.StructType([T.StructField("results", T.ArrayType(T.StructType(
    [T.StructField(f, T.StringType()) for f in OCCURRENCE_FIELDS])))])


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _vpresent(v: Column, path: str) -> Column:
    """The path exists in the parsed payload (an explicit JSON null counts as present)."""
    return F.try_variant_get(v, path, "variant").isNotNull()


def _vtype(v: Column, path: str) -> Column:
    """The JSON type at the path as a type name (``STRING``, ``BIGINT``, ``VOID``, ..); NULL
    when the path is absent."""
    return F.schema_of_variant(F.try_variant_get(v, path, "variant"))


def _not_text(v: Column, path: str) -> Column:
    """Present, but not a JSON string."""
    return F.coalesce(_vtype(v, path) != "STRING", F.lit(False))


def _not_text_or_null(v: Column, path: str) -> Column:
    return F.coalesce(~_vtype(v, path).isin("STRING", "VOID"), F.lit(False))


def _not_integer(v: Column, path: str) -> Column:
    """Present, but neither a whole number nor a text of one."""
    kind = _vtype(v, path)
    number = F.try_variant_get(v, path, "double")
    text = F.try_variant_get(v, path, "string")
    whole = F.when(kind == "STRING", text.rlike(r"^\s*[+-]?[0-9]+\s*$")).when(
        kind.rlike("^(BIGINT|DECIMAL|DOUBLE)"), number == F.floor(number)).otherwise(F.lit(False))
    return kind.isNotNull() & ~F.coalesce(whole, F.lit(False))


def validate_pages(df: DataFrame, key: str = "species_key", summary_status="summary_status",
                   summary_data="summary_data", extracts_data="extracts_data",
                   resolved_via=None) -> DataFrame:
    """Page contract.  Rules, first failure wins: status 404 -> PAGE_NOT_FOUND, other
    non-200 -> HTTP_ERROR (absent status counts as 200); no summary body ->
    PAGE_NOT_FOUND; disambiguation -> DISAMBIGUATION_PAGE; extract shorter than 50
    code points -> EXTRACT_TOO_SHORT; empty sections text -> MISSING_SECTIONS_TEXT;
    a title that is empty or no text, or a URL that is present but no text -> HTTP_ERROR
    (contract; an absent URL is '')."""
    status = F.coalesce(_col(summary_status).cast("int"), F.lit(200))
    # one parse of the summary payload; fields are read from the variant
    staged = df.select("*", F.try_parse_json(_col(summary_data)).alias("_sv"))
    sv = F.col("_sv")
    no_body = sv.isNull() | F.is_variant_null(sv)
    title = F.when(_vpresent(sv, "$.title"), F.try_variant_get(sv, "$.title", "string")) \
        .otherwise(F.lit(""))
    extract = F.when(_vpresent(sv, "$.extract"), F.try_variant_get(sv, "$.extract", "string")) \
        .otherwise(F.lit(""))
    page_url = F.coalesce(F.try_variant_get(sv, "$.content_urls.desktop.page", "string"),
                          F.lit(""))
    # extracts: the page map keeps its JSON order (the first page wins), so it is read
    # with from_json; a non-object or empty payload yields no pages -> ''
    first_page = first_map_value(F.from_json(_col(extracts_data), EXTRACTS_SCHEMA)["query"]["pages"])
    sections = F.coalesce(first_page["extract"], F.lit(""))
    out = staged.select(*df.columns, status.alias("_status"), title.alias("title"),
                        extract.alias("extract"), sections.alias("sections_text"),
                        page_url.alias("page_url"),
                        (_not_text(sv, "$.title") | _not_text(sv, "$.content_urls.desktop.page"))
                        .alias("_mistyped"), no_body.alias("_no_body"),
                        (F.try_variant_get(sv, "$.type", "string") == "disambiguation")
                        .alias("_disambig"),
                        (_col(resolved_via) if resolved_via is not None else F.lit(None))
                        .cast("string").alias("_via"))
    out = out.withColumn("resolved_via", F.coalesce(F.col("_via"), F.lit("DIRECT_TITLE")))
    k, st = F.col(key).cast("string"), F.col("_status")
    rules = [
        (R.PAGE_NOT_FOUND, st == 404),
        (R.HTTP_ERROR, st != 200),
        (R.PAGE_NOT_FOUND, F.col("_no_body")),
        (R.DISAMBIGUATION_PAGE, F.col("_disambig")),
        (R.EXTRACT_TOO_SHORT, F.coalesce(F.length("extract"), F.lit(0)) < 50),
        (R.MISSING_SECTIONS_TEXT, F.col("sections_text") == ""),
        (R.HTTP_ERROR, F.coalesce(F.length("title"), F.lit(0)) < 1),
        (R.HTTP_ERROR, F.col("_mistyped")),
    ]
    contexts = [
        (st != 200, [("http_status", st), ("species_key", k)]),
        (F.col(R.REASON) == R.DISAMBIGUATION_PAGE, [("species_key", k), ("title", F.col("title"))]),
        (F.col(R.REASON) == R.EXTRACT_TOO_SHORT,
         [("species_key", k), ("extract_length", F.coalesce(F.length("extract"), F.lit(0)))]),
        (F.col(R.REASON) == R.HTTP_ERROR,
         [("species_key", k), ("error", F.when(F.col("_mistyped"), F.lit("title or page_url: not a string")).otherwise(
             F.lit("title: string should have at least 1 character")))]),
        (F.lit(True), [("species_key", k)]),
    ]
    out = R.with_rules(out, rules, contexts)
    return (out.withColumn("is_disambiguation", F.lit(False))
            .drop("_status", "_no_body", "_disambig", "_via", "_mistyped"))


def validate_taxonomy(df: DataFrame, key: str = "species_key", status="status",
                      data="data") -> DataFrame:
    """Taxonomy contract: non-200 -> HTTP_ERROR; empty or non-object body ->
    NO_MATCH_RETURNED; match type other than EXACT (or absent) -> MATCH_TYPE_NOT_EXACT;
    a field present but null (optional ranks may be null) or of another JSON type than
    text or whole number -> HTTP_ERROR (contract).
    Absent optional keys take defaults (usage key 0, names '', confidence 0)."""
    st = F.coalesce(_col(status).cast("int"), F.lit(200))
    out = df.select("*", st.alias("_status"), F.try_parse_json(_col(data)).alias("_v"))
    v = F.col("_v")
    required = [("usageKey", "usage_key", "int", F.lit(0)),
                ("scientificName", "scientific_name", "string", F.lit("")),
                ("canonicalName", "canonical_name", "string", F.lit("")),
                ("rank", "rank", "string", F.lit("")),
                ("matchType", "match_type", "string", F.lit("")),
                ("confidence", "confidence", "int", F.lit(0))]
    broken = F.lit(False)
    for src, _, typ, _ in required:
        wrong = _not_integer if typ == "int" else _not_text
        broken = broken | wrong(v, f"$.{src}")
    for src in ("kingdom", "phylum", "class"):
        broken = broken | _not_text_or_null(v, f"$.{src}")
    match_type = F.try_variant_get(v, "$.matchType", "string")
    is_object = F.coalesce(F.size(F.try_variant_get(v, "$", "map<string,variant>")), F.lit(0)) > 0
    rules = [
        (R.HTTP_ERROR, F.col("_status") != 200),
        (R.NO_MATCH_RETURNED, ~is_object),
        (R.MATCH_TYPE_NOT_EXACT, F.coalesce(match_type != "EXACT", F.lit(True))),
        (R.HTTP_ERROR, broken),
    ]
    k = F.col(key).cast("string")
    contexts = [
        (F.col("_status") != 200, [("http_status", F.col("_status")), ("species_key", k)]),
        (F.col(R.REASON) == R.MATCH_TYPE_NOT_EXACT,
         [("species_key", k), ("match_type", match_type)]),
        (F.col(R.REASON) == R.HTTP_ERROR,
         [("species_key", k), ("error", F.lit("required field is null or mistyped"))]),
        (F.lit(True), [("species_key", k)]),
    ]
    out = R.with_rules(out, rules, contexts)
    typed = [F.coalesce(F.try_variant_get(v, f"$.{src}", typ), dflt).alias(dst)
             for src, dst, typ, dflt in required]
    typed += [F.try_variant_get(v, f"$.{src}", "string").alias(dst)
              for src, dst in (("kingdom", "kingdom"), ("phylum", "phylum"), ("class", "class_name"))]
    return out.select(*[c for c in df.columns], *typed, R.REASON, R.CONTEXT)


def validate_occurrences(df: DataFrame, key: str = "species_key") -> DataFrame:
    """Occurrence contract over raw text fields (``OCCURRENCE_FIELDS``).

    Rules: id falsy -> MISSING_GBIF_ID; latitude or longitude missing ->
    MISSING_COORDINATES; not numeric or outside [-90, 90] / [-180, 180] (NaN and
    infinities too) -> COORDINATES_OUT_OF_RANGE; basis falsy ->
    MISSING_BASIS_OF_RECORD; non-empty unparseable date -> INVALID_EVENT_DATE; id
    not an integer or uncertainty not numeric -> HTTP_ERROR (contract)."""
    gid, lat_raw, lon_raw = F.col("gbifID"), F.col("decimalLatitude"), F.col("decimalLongitude")
    unc_raw = F.col("coordinateUncertaintyInMeters")
    # columns of their own: rules, context and result read them, each text is parsed once
    staged = df.select("*", safe_double(lat_raw).alias("_lat"), safe_double(lon_raw).alias("_lon"),
                       safe_double(unc_raw).alias("_unc"), gid.try_cast("long").alias("_gid"),
                       date_parts(F.col("eventDate")).alias("_parts"))
    staged = staged.withColumn("_event_date", date_of_parts(F.col("_parts")))
    lat, lon, unc, gid_long = F.col("_lat"), F.col("_lon"), F.col("_unc"), F.col("_gid")
    unc_bad = (F.coalesce(unc_raw.cast("string"), F.lit("")) != "") & unc.isNull()
    in_range = lat.between(-90.0, 90.0) & lon.between(-180.0, 180.0)
    rules = [
        (R.MISSING_GBIF_ID, is_falsy(gid)),
        (R.MISSING_COORDINATES, lat_raw.isNull() | lon_raw.isNull()),
        (R.COORDINATES_OUT_OF_RANGE, lat.isNull() | lon.isNull()),
        (R.COORDINATES_OUT_OF_RANGE, ~F.coalesce(in_range, F.lit(False))),
        (R.MISSING_BASIS_OF_RECORD, is_falsy(F.col("basisOfRecord"))),
        (R.INVALID_EVENT_DATE, F.coalesce(F.col("eventDate") != "", F.lit(False))
         & F.col("_event_date").isNull()),
        (R.HTTP_ERROR, gid_long.isNull() | unc_bad),
    ]
    k = F.col(key).cast("string")
    reason = F.col(R.REASON)
    contexts = [
        (reason == R.MISSING_GBIF_ID, [("species_key", k)]),
        (reason == R.COORDINATES_OUT_OF_RANGE,
         [("species_key", k), ("gbif_id", gid), ("lat", lat_raw), ("lon", lon_raw)]),
        (reason == R.INVALID_EVENT_DATE,
         [("species_key", k), ("gbif_id", gid), ("event_date", F.col("eventDate"))]),
        (reason == R.HTTP_ERROR, [("species_key", k), ("gbif_id", gid),
                                  ("error", F.lit("gbif_id or uncertainty not numeric"))]),
        (F.lit(True), [("species_key", k), ("gbif_id", gid)]),
    ]
    out = R.with_rules(staged, rules, contexts)
    return out.select(
        *[c for c in df.columns if c != "country"], R.REASON, R.CONTEXT, gid_long.alias("gbif_id"),
        lat.alias("decimal_latitude"), lon.alias("decimal_longitude"), "country",
        F.col("_event_date").alias("event_date"),
        F.col("basisOfRecord").alias("basis_of_record"),
        F.col("iucnRedListCategory").alias("iucn_red_list_category"),
        F.nullif(unc, F.lit(0.0)).alias("coordinate_uncertainty_m"))


def occurrence_records(envelope_rows: DataFrame, key: str = "species_key",
                       data: str = "data") -> DataFrame:
    """Explode ``data.results[]`` of occurrence responses into one row per record,
    keeping the array position (tie-breaks depend on it).  Only object payloads
    carry records; text payloads give none; every landed record is kept."""
    parsed = F.from_json(F.when(is_nonempty_object(F.col(data)), F.col(data)),
                         OCCURRENCE_RESULTS_SCHEMA)
    return (envelope_rows.select("*", F.posexplode(parsed["results"]).alias("pos", "_rec"))
            .select(*envelope_rows.columns, "pos",
                    *[F.col("_rec")[f].alias(f) for f in OCCURRENCE_FIELDS]))
