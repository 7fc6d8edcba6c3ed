"""Domain views of the driver tables.

The operators are generic (key column, rule list, section map are parameters);
these views bind them to the driver's tables.  Every view reads whole tables:
no id subsets, no row caps (batch search asks for every hundredth vector against all).  Derived dirty values come from the data itself
(event types, sources, languages, value ranges), so the work grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import Tables


def taxonomy_view(t: Tables) -> DataFrame:
    """Keyed taxonomy records: one per nation, the match type decided by its region."""
    n, r = t.nation, t.region
    return (n.join(r, n.n_regionkey == r.r_regionkey)
            .select(F.col("n_nationkey").alias("tax_key"),
                    F.when(F.col("r_name") == "ASIA", F.lit("FUZZY"))
                     .when(F.col("r_name") == "MIDDLE EAST", F.lit(None).cast("string"))
                     .otherwise(F.lit("EXACT")).alias("match_type"),
                    F.col("r_name").alias("kingdom"),
                    F.col("n_name").alias("phylum"),
                    F.when(F.col("r_name") != "AMERICA",
                           F.concat(F.lit("class_"), F.col("r_regionkey").cast("string")))
                     .alias("class_name"),
                    F.lit("NATION").alias("rank")))


def order_observations(t: Tables) -> DataFrame:
    """Orders from 2000 on as observations of their customer (some customers have none):
    arrival order = order key."""
    return t.orders.where(F.year("o_orderdate") >= 2000).select("o_custkey", "o_orderkey", "o_orderpriority", "o_orderstatus",
                           "o_orderdate")


def customer_pivot(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", F.col("c_name").alias("title"), "c_nationkey",
                             "c_mktsegment")


def _k(props: str = "props") -> F.Column:
    return F.get_json_object(F.col(props), "$.k").try_cast("int")


def event_date_text(t: Tables) -> DataFrame:
    """Event times rendered in the shapes landed sources use, some of them invalid."""
    # the property is parsed once here; the expressions below reference the column
    ev = t.events.select("event_id", "user_id", "event_type", "value", "ts",
                                 _k().alias("k"))
    k, et, ts = F.col("k"), F.col("event_type"), F.col("ts")
    raw = (F.when(et == "click", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))
           .when(et == "view", F.date_format(ts, "yyyy-MM-dd"))
           .when(et == "purchase", F.date_format(ts, "yyyy"))
           .when(et == "signup", F.when(k < 50, F.date_format(ts, "yyyy-MM"))
                 .otherwise(F.date_format(ts, "yyyy-M-d")))
           .otherwise(F.when(k == 0, F.lit("")).otherwise(
               F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))))
    return ev.select("event_id", "user_id", "event_type", "value", "ts", "k",
                     raw.alias("raw_date"))


def occurrence_raw(t: Tables) -> DataFrame:
    """Events as raw occurrence records of their user (all fields as landed text)."""
    e = event_date_text(t)
    et, k, v = F.col("event_type"), F.col("k"), F.col("value")
    return e.select(
        "event_id", F.col("user_id").alias("species_key"),
        F.when((et == "signup") & (v < 5), F.lit(None)).otherwise(
            F.col("event_id").cast("string")).alias("gbifID"),
        F.when((et == "error") & (k < 3), F.lit("n/a")).otherwise(
            (v / 2.5 - 90).cast("string")).alias("decimalLatitude"),
        F.when((et == "view") & (k > 90), F.lit(None)).otherwise(
            (v - 180).cast("string")).alias("decimalLongitude"),
        F.concat(F.lit("C"), F.floor(v / 50).cast("string")).alias("country"),
        F.col("raw_date").alias("eventDate"),
        F.when((et == "error") & k.between(3, 10), F.lit("")).otherwise(F.upper(et))
        .alias("basisOfRecord"),
        F.when(k < 30, F.lit("LC")).when(k < 60, F.lit("NT")).otherwise(F.lit("VU"))
        .alias("iucnRedListCategory"),
        F.when((et == "purchase") & (k > 95), F.concat(F.lit("x"), k.cast("string")))
        .otherwise(k.cast("string")).alias("coordinateUncertaintyInMeters"))


def taxonomy_responses(t: Tables) -> DataFrame:
    """Parts as landed taxonomy responses: HTTP status plus JSON body text."""
    p = t.part
    body = F.to_json(F.struct(
        F.when((F.col("p_type") == "MEDIUM") & (F.col("p_size") == 1), F.lit(None))
        .otherwise(F.col("p_partkey")).alias("usageKey"),
        F.col("p_name").alias("scientificName"),
        F.col("p_brand").alias("canonicalName"),
        F.col("p_type").alias("rank"),
        F.when(F.col("p_size") > 40, F.lit("FUZZY")).when(F.col("p_size") == 40, F.lit(None))
        .otherwise(F.lit("EXACT")).alias("matchType"),
        F.col("p_size").alias("confidence"),
        F.col("p_brand").alias("kingdom"),
        F.col("p_type").alias("phylum"),
        F.when(F.col("p_size") >= 10, F.concat(F.lit("size_"), F.col("p_size").cast("string")))
        .alias("class"),
    ), {"ignoreNullFields": "false"})
    key, size = F.col("p_partkey").cast("string"), F.col("p_size")
    # some bodies get values of the wrong JSON type: a fraction as id, numbers as names
    body = (F.when((F.col("p_type") == "PROMO") & (size < 6), F.replace(
                body, F.concat(F.lit('"usageKey":'), key), F.concat(F.lit('"usageKey":'), key, F.lit(".5"))))
            .when((F.col("p_type") == "SMALL") & (size < 8), F.replace(
                body, F.concat(F.lit('"scientificName":"'), F.col("p_name"), F.lit('"')), F.lit('"scientificName":5')))
            .when((F.col("p_type") == "LARGE") & (size < 10), F.replace(
                body, F.concat(F.lit('"kingdom":"'), F.col("p_brand"), F.lit('"')), F.lit('"kingdom":7')))
            .otherwise(body))
    data = (F.when((F.col("p_type") == "LARGE") & (F.col("p_size") < 5), F.lit("{}"))
            .when((F.col("p_type") == "SMALL") & (F.col("p_size") < 3), F.lit("not found"))
            .otherwise(body))
    status = F.when((F.col("p_type") == "PROMO") & (F.col("p_size") > 45), F.lit(500)) \
        .otherwise(F.lit(200))
    return p.select("p_partkey", status.alias("status"), data.alias("data"))


def page_responses(t: Tables) -> DataFrame:
    """Documents as landed page responses: summary status/body and extracts body."""
    d = t.documents
    src, key = F.col("source"), F.col("doc_id").cast("string")
    title = F.when(src == "src5", F.lit("")).otherwise(F.concat(F.lit("Doc "), key))
    summary = F.to_json(F.struct(
        title.alias("title"), F.col("text").alias("extract"),
        F.when(src == "src4", F.lit("disambiguation")).otherwise(F.lit("standard")).alias("type"),
        F.struct(F.struct(F.concat(F.lit("https://docs.example/"), key).alias("page"))
                 .alias("desktop")).alias("content_urls")))
    # some bodies get a number as title or a null page address
    summary = (F.when(src == "src6", F.replace(summary, F.concat(F.lit('"title":"Doc '), key, F.lit('"')),
                                              F.concat(F.lit('"title":'), key)))
               .when(src == "src7", F.replace(summary, F.concat(F.lit('"page":"https://docs.example/'), key, F.lit('"')),
                                              F.lit('"page":null'))).otherwise(summary))
    page = F.struct(title.alias("title"),
                    F.when(F.col("lang") == "de", F.lit("")).otherwise(F.col("text"))
                    .alias("extract"))
    pages = F.struct(F.create_map(key, page).alias("pages"))
    extracts = F.to_json(F.struct(pages.alias("query")))
    return d.select("doc_id",
                    F.when(src == "src1", F.lit(404)).when(src == "src2", F.lit(500))
                    .otherwise(F.lit(200)).alias("summary_status"),
                    F.when(src == "src3", F.lit("null")).otherwise(summary).alias("summary_data"),
                    extracts.alias("extracts_data"))


ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


def order_batches(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Orders landed as two overlapping batches by order date.  The second batch
    restates 1997+ orders (status 'U') and, later in the same batch, 1999+ orders
    again (status 'V', price + 1) - so it also holds repeated keys."""
    o = t.orders.select(*ORDER_COLUMNS, "o_orderdate")
    b1 = o.where(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")) \
        .withColumn("ord", F.lit(1))
    b2a = (o.where(F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
           .withColumn("o_orderstatus", F.lit("U")).withColumn("ord", F.lit(1)))
    b2b = (o.where(F.col("o_orderdate") >= F.lit("1999-01-01").cast("timestamp_ntz"))
           .withColumn("o_orderstatus", F.lit("V"))
           .withColumn("o_totalprice", F.col("o_totalprice") + 1).withColumn("ord", F.lit(2)))
    return b1.drop("o_orderdate"), b2a.unionByName(b2b).drop("o_orderdate")


CATALOG_COLUMNS = ("species_key", "scientific_name", "wikipedia_title", "first_seen_batch_id",
                   "first_processed_at", "last_processed_at", "origin")
CATALOG_INSERT_ONLY = ("scientific_name", "first_seen_batch_id", "first_processed_at", "origin")


def seed_keys(t: Tables) -> DataFrame:
    """The seed list: users that are AUTOMOBILE customers."""
    return t.customer.where(F.col("c_mktsegment") == "AUTOMOBILE") \
        .select(F.col("c_custkey").alias("species_key"))


def catalog_records(t: Tables) -> DataFrame:
    """Every event as a catalog record of its user; batch = event day.  The origin flag
    depends on the key only and is added after the per-key collapse (``with_origin``)."""
    e = t.events.select(F.col("user_id").alias("species_key"), "event_id", "event_type", "ts")
    return e.select("species_key", "event_id", "ts",
                    F.col("event_type").alias("scientific_name"),
                    F.col("event_type").alias("wikipedia_title"),
                    F.concat(F.lit("day_"), F.date_format("ts", "yyyy-MM-dd"))
                    .alias("first_seen_batch_id"),
                    F.col("ts").alias("first_processed_at"),
                    F.col("ts").alias("last_processed_at"))


def with_origin(t: Tables):
    """``derive`` hook: SEED when the key is on the seed list, else AD_HOC."""
    seed = seed_keys(t).withColumn("_seed", F.lit(True))

    def derive(collapsed: DataFrame) -> DataFrame:
        return (collapsed.join(seed, "species_key", "left")
                .withColumn("origin", F.when(F.col("_seed"), F.lit("SEED"))
                            .otherwise(F.lit("AD_HOC"))).drop("_seed"))
    return derive


CATALOG_SPLIT = "2024-01-16"


# Test input: heading titles given to conversation turns (some map to the same canonical
# section, some to none).
TURN_HEADINGS = ["Description and morphology", "Distribution and habitat", "Habitat", "Behavior",
                 "Diet and feeding", "Prey", "Reproduction", "Conservation status",
                 "Human interaction", "References", "Gallery", "Etymology", "Identity",
                 "Taxonomy", "See also", "Life cycle"]


def turn_blocks(t: Tables) -> DataFrame:
    """Each conversation turn as one headed block: ``== heading ==`` (``===`` for
    assistant turns) and the turn text below; system turns carry only the heading."""
    c = t.conversations
    idx = F.pmod(F.col("conv_id") * 7 + F.col("turn"), F.lit(len(TURN_HEADINGS))) + 1
    heading = F.element_at(F.array(*[F.lit(h) for h in TURN_HEADINGS]), idx.cast("int"))
    marks = F.when(F.col("role") == "assistant", F.lit("===")).otherwise(F.lit("=="))
    line = F.concat(marks, F.lit(" "), heading, F.lit(" "), marks)
    block = F.when(F.col("role") == "system", line) \
        .otherwise(F.concat(line, F.lit("\n"), F.col("text")))
    return c.select("conv_id", "turn", "role", heading.alias("heading"), block.alias("block"))


def conversation_documents(t: Tables) -> DataFrame:
    """One document per conversation: a preamble line, then the turn blocks in turn
    order.  A conversation is one document, so it is assembled in one row; the
    per-conversation list is bounded by the turns of that conversation."""
    b = turn_blocks(t)
    ordered = F.array_sort(F.collect_list(F.struct("turn", "block")))
    docs = b.groupBy("conv_id").agg(
        F.array_join(F.transform(ordered, lambda s: s["block"]), "\n").alias("_body"),
        F.min(F.when(F.col("turn") == 0, F.col("role"))).alias("_first_role"),
        F.max_by("role", "turn").alias("_last_role"),
        F.count(F.lit(1)).alias("_turns"),
        F.max((F.col("role") == "system").cast("int")).alias("_has_system"))
    key = F.concat(F.lit("conv_"), F.col("conv_id").cast("string"))
    return docs.select(
        key.alias("species_key"),
        F.concat(F.lit("Conversation "), F.col("conv_id").cast("string")).alias("wikipedia_title"),
        F.concat(F.lit("Conversation "), F.col("conv_id").cast("string"), F.lit("\n"),
                 F.col("_body")).alias("sections_text"),
        F.when(F.col("_has_system") == 1, F.lit("MATCHED")).otherwise(F.lit("UNMATCHED"))
        .alias("taxonomy_status"),
        F.col("_first_role").alias("kingdom"), F.col("_last_role").alias("phylum"),
        F.lit(None).cast("string").alias("class_name"),
        F.concat(F.lit("turns_"), F.col("_turns").cast("string")).alias("rank"))


VECTOR_DIM = 64  # of the driver's embeddings


def resolved_pages(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Names, their resolution and landed page responses: the page of name ``doc-7`` is fetched
    under its resolved title ``Page 7``.  Names of src8 are ambiguous, pages of src9 were never
    landed, and pages of src10 were fetched twice, first with an error."""
    d, key = t.documents, F.col("doc_id").cast("string")
    name, title = F.concat(F.lit("doc-"), key), F.concat(F.lit("Page "), key)
    ambiguous = F.col("source") == "src8"
    resolution = d.select(
        name.alias("name"), F.when(ambiguous, F.lit("AMBIGUOUS_RESOLUTION")).otherwise(F.lit("SUCCESS")).alias("status"),
        F.when(~ambiguous, F.lit("SEARCH")).alias("resolved_via"), F.when(~ambiguous, title).alias("title"),
        F.when(ambiguous, F.array(title, F.concat(title, F.lit(" (other)")))).alias("candidates"))
    pr = page_responses(t).join(d.select("doc_id", "source"), "doc_id").where("source != 'src9'")
    summary = pr.select(title.alias("title"), F.concat(F.lit("summary:"), title).alias("query"),
                        F.col("summary_status").alias("status"), F.col("summary_data").alias("data"), "source")
    extracts = pr.select(title.alias("title"), F.concat(F.lit("extracts:"), title).alias("query"),
                         F.lit(200).alias("status"), F.col("extracts_data").alias("data"), "source")
    return d.select(name.alias("name")), resolution, summary.unionByName(extracts)


def occurrence_responses(t: Tables) -> DataFrame:
    """Events as landed occurrence responses of their user's name, one record a page."""
    o = occurrence_raw(t)
    record = F.struct(*[F.col(c) for c in ("gbifID", "decimalLatitude", "decimalLongitude", "country", "eventDate",
                                           "basisOfRecord", "iucnRedListCategory", "coordinateUncertaintyInMeters")])
    name = F.concat(F.lit("doc-"), F.col("species_key").cast("string"))
    return o.select(name.alias("name"), F.concat(name, F.lit("?offset="), F.col("event_id").cast("string")).alias("query"),
                    F.lit(200).alias("status"), F.to_json(F.struct(F.array(record).alias("results"))).alias("data"))


def vector_chunks(t: Tables) -> DataFrame:
    """Embeddings as chunk vectors: chunk id = vec_id, parent = label."""
    return t.embeddings.select("vec_id", "label", "embedding",
                               F.concat(F.lit("vector "), F.col("vec_id").cast("string"))
                               .alias("text"))


def label_metadata(t: Tables) -> DataFrame:
    """Parent metadata per label: the nation with the same number and its region."""
    labels = t.embeddings.groupBy("label").agg(F.count(F.lit(1)).alias("n_vectors"))
    n, r = t.nation, t.region
    region_nations = n.groupBy("n_regionkey").agg(
        F.array_sort(F.collect_list("n_name")).alias("paises"))
    nat = (n.join(r, n.n_regionkey == r.r_regionkey)
           .join(region_nations, "n_regionkey")
           .select("n_nationkey", "n_name", "r_name", "n_regionkey", "paises"))
    return (labels.join(nat, labels.label == nat.n_nationkey, "left")
            .select("label",
                    F.concat(F.lit("label_"), F.col("label").cast("string")).alias("wikipedia_title"),
                    F.col("r_name").alias("kingdom"), F.col("n_name").alias("phylum"),
                    F.lit("MATCHED").alias("taxonomy_status"),
                    F.when(F.col("n_regionkey") == 0, F.lit("LC"))
                    .when(F.col("n_regionkey") == 1, F.lit("NT")).otherwise(F.lit("VU"))
                    .alias("iucn_red_list_category"),
                    "paises", (F.lit(1990) + F.col("label")).alias("anio_min"),
                    (F.lit(2000) + F.col("label")).alias("anio_max"),
                    F.col("n_vectors").cast("int").alias("n_occurrences_validas")))


def label_centroids(t: Tables) -> DataFrame:
    """One query per label: the mean of its vectors (dimension-wise)."""
    e = t.embeddings.select("label", F.posexplode("embedding").alias("pos", "x"))
    per_dim = e.groupBy("label", "pos").agg(F.avg("x").alias("m"))
    return per_dim.groupBy("label").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "m"))), lambda s: s["m"])
        .alias("query_vec")).withColumnRenamed("label", "query_id")


def resolution_inputs(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Names = one per document; directory = all pages (plus their disambiguation and
    redirect flags from the URL); search hits = the turns of the conversation with the
    same number (rank = turn + 1)."""
    names = t.documents.select(F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("name"))
    p = t.pages
    directory = p.select(
        F.concat(F.lit("doc-"), F.col("page_id").cast("string")).alias("query_title"),
        F.regexp_extract("html", "<title>(.*?)</title>", 1).alias("page_title"),
        F.col("url").contains("?page=").alias("is_disambiguation"),
        F.col("url").contains("#").alias("was_redirected"))
    c = t.conversations
    n = F.col("conv_id").cast("string")
    hit_title = F.when(F.col("role") == "assistant",
                       F.concat(F.lit("p-"), n, F.lit("-"), F.col("turn").cast("string"))) \
        .otherwise(F.concat(F.lit("doc-"), n, F.col("turn").cast("string")))
    hits = c.select(F.concat(F.lit("doc-"), n).alias("name"),
                    (F.col("turn") + 1).cast("int").alias("rank"), hit_title.alias("hit_title"),
                    F.col("text").alias("snippet"))
    return names, directory, hits
