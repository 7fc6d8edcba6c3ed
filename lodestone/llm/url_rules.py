"""URL filter: fixed host and path rules, and association rules mined from labelled URLs.

FP-growth (Spark's) finds the combinations of URL tokens and label that are frequent among the
labelled URLs; the rules "tokens => block" and "tokens => allow" with enough confidence are
kept, less those that a shorter rule of at least the same confidence already implies.  Which of
the fitting rules counts is decided by lift, the confidence over the base rate of the verdict:
with mostly good labels nearly any token "allows" at the base rate, which says nothing.  Each rule
is indexed under its rarest token, so a URL meets only rules one of whose tokens it has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

SUPPORT, LEAST_URLS, CONFIDENCE = 0.003, 5, 0.6
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
Rule = tuple[str, str, str]  # verdict, host, path


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def fixed_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """(verdict, rule) of the longest fitting rule, null if none fits: a rule fits its host
    and all subdomains where the path starts with the rule's."""
    out = F.lit(None).cast("struct<verdict: string, rule: string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        out = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(h + p).alias("rule"))).otherwise(out)
    return out


def url_tokens(url: Column) -> Column:
    """Distinct tokens of a URL: scheme, host labels by place from the right, directory and
    file words, query keys.  Numbers are one token, so that single pages are not learnt."""
    host, path = host_of(url), path_of(url)
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    words = F.filter(F.split(F.translate(path, UPPER, LOWER), r"[^a-z0-9]+"), lambda w: w != "")
    shaped = F.transform(words, lambda w: F.when(w.rlike("^[0-9]+$"), F.lit("path:#")).otherwise(F.concat(F.lit("path:"), w)))
    labels = F.reverse(F.filter(F.split(host, r"\."), lambda w: w != ""))
    hosts = F.transform(labels, lambda w, i: F.concat(F.lit("host"), i.cast("string"), F.lit(":"), w))
    keys = F.transform(F.filter(F.split(query, "&"), lambda w: w != ""),
                       lambda w: F.concat(F.lit("key:"), F.regexp_extract(w, "^[^=]*", 0)))
    scheme = F.array(F.concat(F.lit("scheme:"), F.translate(F.regexp_extract(url, "^([A-Za-z]+)://", 1), UPPER, LOWER)))
    return F.when(url.isNull(), F.array().cast("array<string>")).otherwise(
        F.array_distinct(F.concat(scheme, hosts, shaped, keys)))


def mine_rules(labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """(rule_id, tokens, verdict, confidence, support, lift) from (tokens, bad); two marks cannot
    both hold, and equal rules cannot appear twice.  A rule needs ``support`` of the labelled
    URLs and ``LEAST_URLS`` of them at least."""
    mark = F.when(F.col("bad"), F.lit("label:block")).otherwise(F.lit("label:allow"))
    baskets = cut_lineage(labelled.where("bad is not null").select(F.array_append("tokens", mark).alias("items")))
    schema = "rule_id long, tokens array<string>, verdict string, confidence double, support double, lift double"
    n = baskets.count()
    if n < LEAST_URLS:
        return labelled.sparkSession.createDataFrame([], schema)
    model = FPGrowth(itemsCol="items", minSupport=max(support, LEAST_URLS / n),
                     minConfidence=confidence).fit(baskets)
    rules = cut_lineage(
        model.associationRules.where(F.size("consequent") == 1)
        .select(F.array_sort("antecedent").alias("tokens"), F.col("consequent")[0].alias("head"),
                "confidence", "support", "lift")
        .where(F.startswith("head", F.lit("label:")) & ~F.exists("tokens", lambda t: F.startswith(t, F.lit("label:"))))
        .select("tokens", F.substring_index("head", ":", -1).alias("verdict"), "confidence", "support", "lift"))
    # a rule is implied by one with all but one of its tokens, the same verdict and no less confidence
    shorter = rules.select(F.col("tokens").alias("part"), F.col("verdict").alias("v"), F.col("confidence").alias("c"))
    parts = rules.select("tokens", "verdict", "confidence", F.explode(F.transform(
        F.col("tokens"), lambda t: F.array_remove(F.col("tokens"), t))).alias("part"))
    implied = (parts.join(shorter, "part").where("verdict = v and c >= confidence")
               .select("tokens", "verdict").distinct())
    # but not if it is an exception: to a rule with a part of its tokens, the other verdict and more lift
    wider = rules.select(F.col("tokens")[0].alias("token"), F.col("tokens").alias("wide"),
                         F.col("verdict").alias("other"), F.col("lift").alias("more"))
    exceptions = (rules.select("tokens", "verdict", "lift", F.explode("tokens").alias("token")).join(wider, "token")
                  .where((F.col("other") != F.col("verdict")) & (F.col("more") > F.col("lift"))
                         & (F.size("wide") < F.size("tokens")) & (F.size(F.array_except("wide", "tokens")) == 0))
                  .select("tokens", "verdict").distinct())
    return (rules.join(implied.join(exceptions, ["tokens", "verdict"], "left_anti"), ["tokens", "verdict"], "left_anti")
            .withColumn("rule_id", F.xxhash64("tokens", "verdict")))


def match_rules(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """(row, verdict, confidence): the best fitting rule of each of ``pages`` (row, tokens)
    that any rule fits.  A rule gives way to a fitting one with all its tokens and more; of the
    others the one of the highest lift counts, then confidence, support, more tokens, the rule id."""
    df = pages.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("df"))
    listed = rules.select("rule_id", F.explode("tokens").alias("token"))
    index = (listed.join(df, "token").groupBy("rule_id").agg(F.min_by("token", F.struct("df", "token")).alias("token"))
             .join(rules.withColumnRenamed("tokens", "needs"), "rule_id"))
    rule = F.struct("lift", "confidence", "support", F.size("needs").alias("n"), "rule_id", "verdict", "needs")
    narrower = lambda r: lambda q: (F.size(q["needs"]) > F.size(r["needs"])) & (
        F.size(F.array_except(r["needs"], q["needs"])) == 0)
    return (pages.select("row", "tokens", F.explode("tokens").alias("token")).join(index, "token")
            .where(F.size(F.array_except("needs", "tokens")) == 0)
            .groupBy("row").agg(F.collect_list(rule).alias("fit"))
            .select("row", F.array_max(F.filter("fit", lambda r: ~F.exists("fit", narrower(r)))).alias("best"))
            .select("row", F.col("best.verdict").alias("verdict"), F.col("best.confidence").alias("confidence")))


def judge_urls(pages: DataFrame, bad: DataFrame, rules: Sequence[Rule], support: float = SUPPORT,
               confidence: float = CONFIDENCE) -> DataFrame:
    """One row per row of ``pages`` (page_id, url; other columns are ignored): page_id, host,
    path, rule (the longest fitting fixed rule, else null), verdict (the rule's, else the best
    mined rule's, else allow), confidence (of the mined rule, null without one).

    ``bad`` has labelled URLs (url, bad).  A null URL or one without ``://`` has an empty host
    and path, no fixed rule and its few tokens; a null page_id stays null; repeated rows are
    judged alike, each.  Without labels, or rules that pass, all that no fixed rule judges is
    allowed; an empty table gives no rows."""
    mined = cut_lineage(mine_rules(bad.select(url_tokens(F.col("url")).alias("tokens"), "bad")
                                   .where("size(tokens) > 0"), support, confidence))
    read = pages.select("page_id", "url", F.xxhash64("url").alias("row"))
    judged = read.select("page_id", "row", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    open_urls = read.where("url is not null").select("url", "row").dropDuplicates(["url"])
    found = match_rules(open_urls.select("row", url_tokens(F.col("url")).alias("tokens")), mined)
    fixed = fixed_rule(F.col("host"), F.col("path"), rules)
    return (judged.withColumn("fixed", fixed).join(found, "row", "left")
            .select("page_id", "host", "path", F.col("fixed.rule").alias("rule"),
                    F.coalesce("fixed.verdict", "verdict", F.lit("allow")).alias("verdict"), "confidence"))
