"""Title resolution as a decision table over pre-fetched tables (no network).

Inputs: the names to resolve; a page directory (one row per title that exists:
the page title it leads to, whether it is a disambiguation page, whether a
redirect was followed); ranked search hits per name (rank 1 = top).
Rules, first match wins:

1. direct page found and disambiguation -> DISAMBIGUATION_PAGE (via REDIRECT or DIRECT_TITLE)
2. direct page found -> SUCCESS via REDIRECT or DIRECT_TITLE
3. no search hit -> PAGE_NOT_FOUND
4. top hit's page missing -> PAGE_NOT_FOUND (with candidates)
5. top hit is disambiguation, second hit's page exists and is not -> SUCCESS via SEARCH, second
6. top hit is disambiguation -> DISAMBIGUATION_PAGE via SEARCH
7. two or more hits and the lower-cased name is contained in snippet or title of both the
   top and the second hit -> AMBIGUOUS_RESOLUTION (no title)
8. otherwise SUCCESS via SEARCH with the top hit
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Resolution statuses and resolution methods.
SUCCESS, PAGE_NOT_FOUND = "SUCCESS", "PAGE_NOT_FOUND"
AMBIGUOUS_RESOLUTION, DISAMBIGUATION_PAGE = "AMBIGUOUS_RESOLUTION", "DISAMBIGUATION_PAGE"
DIRECT_TITLE, SEARCH, REDIRECT = "DIRECT_TITLE", "SEARCH", "REDIRECT"


def resolve_titles(names: DataFrame, directory: DataFrame, hits: DataFrame, *,
                   name: str = "name", dir_key: str = "query_title") -> DataFrame:
    """``names(name)``, ``directory(query_title, page_title, is_disambiguation,
    was_redirected)``, ``hits(name, rank, hit_title, snippet)`` ->
    ``name, status, resolved_via, title, candidates``."""
    per_name = hits.groupBy(name).agg(
        F.count(F.lit(1)).alias("n_hits"),
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "hit_title"))),
                    lambda s: s["hit_title"]).alias("candidates"),
        F.min_by(F.struct("hit_title", "snippet"), "rank").alias("top"),
        F.min_by(F.when(F.col("rank") > 1, F.struct("hit_title", "snippet")),
                 F.when(F.col("rank") > 1, F.col("rank"))).alias("second"))
    base = names.select(name).distinct().join(per_name, name, "left")
    # the three titles a name may lead to, looked up in the directory by one join
    roles = {"direct": F.col(name), "top": F.col("top.hit_title"), "sec": F.col("second.hit_title")}
    wanted = base.select(name, F.explode(F.array(*[
        F.struct(F.lit(r).alias("role"), c.alias("title")) for r, c in roles.items()])).alias("w")).select(
        name, "w.role", F.col("w.title").alias("_dk")).where("_dk is not null")
    found = wanted.join(directory.select(F.col(dir_key).alias("_dk"), F.struct(
        "page_title", "is_disambiguation", "was_redirected").alias("page")), "_dk")
    pages = found.groupBy(name).agg(*[F.first(F.when(F.col("role") == r, F.col("page")), ignorenulls=True)
                                      .alias(f"_{r}") for r in roles])
    pages = pages.select(name, *[c for r in roles for c in (
        F.col(f"_{r}").isNotNull().alias(f"{r}_exists"),
        F.col(f"_{r}.is_disambiguation").alias(f"{r}_disambig"),
        F.col(f"_{r}.page_title").alias(f"{r}_page_title"),
        F.col(f"_{r}.was_redirected").alias(f"{r}_redirected"))])
    j = names.select(name).join(base, name, "left").join(pages, name, "left")

    low = F.lower(F.col(name))

    def has_name(h):
        return (F.contains(F.lower(F.coalesce(h["snippet"], F.lit(""))), low)
                | F.contains(F.lower(F.coalesce(h["hit_title"], F.lit(""))), low))

    direct = F.coalesce(F.col("direct_exists"), F.lit(False))
    via_direct = F.when(F.coalesce(F.col("direct_redirected"), F.lit(False)), F.lit(REDIRECT)) \
        .otherwise(F.lit(DIRECT_TITLE))
    n_hits = F.coalesce(F.col("n_hits"), F.lit(0))
    top_ok = F.coalesce(F.col("top_exists"), F.lit(False))
    top_dis = F.coalesce(F.col("top_disambig"), F.lit(False))
    sec_ok = F.coalesce(F.col("sec_exists"), F.lit(False)) & \
        ~F.coalesce(F.col("sec_disambig"), F.lit(False))
    ambiguous = (n_hits >= 2) & F.coalesce(has_name(F.col("top")) & has_name(F.col("second")),
                                           F.lit(False))
    rule = (F.when(direct & F.coalesce(F.col("direct_disambig"), F.lit(False)), F.lit(1))
            .when(direct, F.lit(2)).when(n_hits == 0, F.lit(3)).when(~top_ok, F.lit(4))
            .when(top_dis & (n_hits > 1) & sec_ok, F.lit(5)).when(top_dis, F.lit(6))
            .when(ambiguous, F.lit(7)).otherwise(F.lit(8)))
    status = (F.when(rule == 1, DISAMBIGUATION_PAGE).when(rule == 2, SUCCESS)
              .when(rule.isin(3, 4), PAGE_NOT_FOUND).when(rule == 5, SUCCESS)
              .when(rule == 6, DISAMBIGUATION_PAGE).when(rule == 7, AMBIGUOUS_RESOLUTION)
              .otherwise(SUCCESS))
    via = (F.when(rule.isin(1, 2), via_direct).when(rule.isin(5, 6, 8), F.lit(SEARCH)))
    title = (F.when(rule.isin(1, 2), F.col("direct_page_title"))
             .when(rule == 5, F.col("second.hit_title"))
             .when(rule.isin(6, 8), F.col("top.hit_title")))
    cands = F.when(rule.isin(4, 6, 7), F.col("candidates"))
    return j.select(F.col(name), status.alias("status"), via.alias("resolved_via"),
                    title.alias("title"), cands.alias("candidates"))
