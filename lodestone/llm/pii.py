"""Personal data: base patterns, and terms that give protected values away.

Base spans are e-mail addresses, IP addresses, card and phone numbers.  Each value found is a
protected entity, and so is the domain of an address: what gives the domain away does so for all
addresses there, each of which may occur once.  Over the whole corpus three document counts are taken: of an entity, of a
term (a word) and of the term within ``REACH`` words of the entity.  The share of an entity's
information that a term discloses is

    PMI(entity; term) / IC(entity),   IC = -log2 p(entity)

(1: who sees the term knows the entity).  Terms at or over ``THRESHOLD`` get spans too wherever
they stand near the entity, if the entity and the term meet in ``SUPPORT`` or more different texts
or, in fewer, more often than chance lets any of the pairs (Bonferroni over all pairs, ``ALPHA``).
Sanitising generalises them (numbers) or removes them (words).  A pair met in a single text is
hardly ever over chance: each word that only this text has would disclose the value fully.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, ship_package
from .decontam import item_words
from .text import U64, WordHash, bounded_batches, texts_of

KINDS = ("email", "ip", "card", "phone", "term")
REACH, SUPPORT, THRESHOLD, ALPHA = 8, 3, 0.8, 0.05
BITS = 1 << 22
#: Distinct terms that a task counts before it passes them on.
COUNTED = 200_000

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# (?<![0-9]): from inside a run of digits nothing matches that did not from its start
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    low, at = 0, text.find("@")
    while at >= 0:
        run = text[low:at]
        start = low + len(run.rstrip(_LOCAL))
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
        low = m.end() if m else at + 1
        at = text.find("@", low)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) in code points by start, then kind as listed."""
    out = [(a, b, 0) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")):
            out.append((m.start(), m.end(), 1))
    for m in _CARD.finditer(text):
        d = _digits(m.group())
        if 12 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), m.end(), 2))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m.group())) <= 15:
                out.append((m.start(), m.end(), 3))
    return [(a, b, KINDS[k]) for a, b, k in sorted(out, key=lambda s: (s[0], s[2]))]


def _entity(kind: str, value: str) -> int:
    """A protected value's 64-bit id: letters lower-cased, numbers by their digits."""
    value = value.lower() if kind == "email" else value if kind == "ip" else _digits(value)
    return xxhash.xxh3_64_intdigest(f"{kind}:{value}") - (1 << 63)


def _entities(kind: str, value: str) -> list[int]:
    """The ids a base span stands for: its value's and, of an e-mail address, its domain's."""
    ids = [_entity(kind, value)]
    if kind == "email":
        ids.append(xxhash.xxh3_64_intdigest(f"domain:{value.rpartition('@')[2].lower()}") - (1 << 63))
    return ids


def words_before(text: str, at: int, count: int) -> list[tuple[int, int]]:
    """The last ``count`` words before ``at``, whole: the part looked at grows until it holds them."""
    size = 64 * count
    while True:
        low = max(0, at - size)
        # a word at the edge may go on before it
        words = [m.span() for m in _WORD.finditer(text, low, at) if m.start() > low or low == 0]
        if len(words) >= count or low == 0:
            return words[-count:] if count else []
        size *= 2


def contexts(text: str, spans: list[tuple[int, int, str]], reach: int = REACH) -> list[dict]:
    """The words within ``reach`` words of each base span, outside of all base spans, with the
    span's entities, each: entity, term, start, end."""
    if not spans:
        return []
    taken = np.array([(a, b) for a, b, _ in spans])
    out = []
    for a, b, kind in spans:
        before = words_before(text, a, reach)
        after = [m.span() for m in islice(_WORD.finditer(text, b), reach)]
        entities = _entities(kind, text[a:b])
        for s, e in before + after:
            if not ((taken[:, 0] < e) & (s < taken[:, 1])).any():
                term = text[s:e].translate(_LOWER)
                out.extend({"entity": i, "term": term, "start": s, "end": e} for i in entities)
    return out


_CONTEXT = "struct<entity: long, term: string, start: long, end: long>"
_SPAN = "struct<kind: string, start: long, end: long>"
_PA_CONTEXT = pa.list_(pa.struct([("entity", pa.int64()), ("term", pa.string()),
                                  ("start", pa.int64()), ("end", pa.int64())]))
_PA_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def find_base(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """(doc_id, key, base, contexts) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, near = [], []
            for text in batch.column("text").to_pylist():
                spans = base_spans(text or "")
                base.append([{"kind": k, "start": a, "end": b} for a, b, k in spans])
                near.append(contexts(text, spans, reach) if spans else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"), pa.array(base, _PA_SPAN),
                 pa.array(near, _PA_CONTEXT)], ["doc_id", "key", "base", "contexts"])

    return docs.select("doc_id", "key", "text").mapInArrow(
        run, f"doc_id long, key long, base array<{_SPAN}>, contexts array<{_CONTEXT}>")


def document_frequency(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, df): how many rows hold each of ``terms``.  A bitmap of fixed size lets only
    likely terms leave the scan, counted by task; the join settles the rest."""
    slots = terms.select(F.col("slot").cast("int").alias("s")).distinct().collect()  # BITS at most
    bits = np.zeros(BITS, dtype=np.uint8)
    bits[[r["s"] for r in slots]] = 1
    bitmap = np.packbits(bits, bitorder="little").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, bits, seen = WordHash(), np.frombuffer(bitmap, dtype=np.uint8), Counter()

        def rows():
            out = pa.RecordBatch.from_arrays(
                [pa.array([w.decode("utf-8", "replace") for w in seen], pa.string()),
                 pa.array(seen.values(), pa.int64())], ["term", "n"])
            seen.clear()
            return out

        for batch in batches:
            for text in texts_of(batch):
                words = list(set(item_words(text)))
                at = (cache.of(words) % U64(BITS)).astype(np.int64)
                seen.update([words[i] for i in
                             np.flatnonzero((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1)])
                if len(seen) > COUNTED:
                    yield rows()
        yield rows()

    counted = docs.select("text").mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("df"))
    return counted.join(terms.select("term").distinct(), "term", "left_semi")


def _slots(terms: DataFrame) -> DataFrame:
    """``terms`` with the bitmap slot of each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t = batch.column("term")
            yield pa.RecordBatch.from_arrays(
                [t, pa.array([xxhash.xxh3_64_intdigest(x) % BITS for x in t.to_pylist()], pa.int64())],
                ["term", "slot"])

    return terms.select("term").mapInArrow(run, "term string, slot long")


def _chance(both, entity, term, texts):
    """Bound of the probability that ``both`` or more of ``entity`` texts are among ``term`` texts
    by chance: the expected number of sets of ``both`` such texts, of ``texts`` in all."""
    return F.aggregate(F.sequence(F.lit(0).cast("long"), both - 1), F.lit(1.0), lambda acc, i: acc * (
        (entity - i) / (i + 1)) * ((term - i) / (texts - i)))


def disclosing_terms(docs: DataFrame, found: DataFrame, support: int = SUPPORT,
                     threshold: float = THRESHOLD, alpha: float = ALPHA) -> DataFrame:
    """(entity, term, disclosure) at or over the threshold.  Equal texts are first summed to
    one row with their number, so a large group of copies costs one row."""
    texts = (found.where(F.size("contexts") > 0).groupBy("key")
             .agg(F.count("*").alias("n"), F.first("contexts").alias("contexts")))
    near = texts.select("key", "n", F.explode("contexts").alias("c")).select(
        "key", "n", F.col("c.entity").alias("entity"), F.col("c.term").alias("term"))
    entities = (near.select("key", "n", "entity").distinct()
                .groupBy("entity").agg(F.count("*").alias("entity_texts"), F.sum("n").alias("n_entity")))
    terms = (near.select("key", "n", "term").distinct()
             .groupBy("term").agg(F.count("*").alias("near_texts"), F.sum("n").alias("n_near")))
    met = cut_lineage(near.distinct().groupBy("entity", "term")
                      .agg(F.count("*").alias("both"), F.sum("n").alias("n_both"))
                      .join(entities, "entity").join(terms, "term"))
    tests, different = max(met.count(), 1), F.lit(max(found.select("key").distinct().count(), 1))
    total = found.count()

    def enough(term_texts):
        return F.when(F.col("both") >= support, F.lit(True)).otherwise(
            _chance(F.col("both"), F.col("entity_texts"), term_texts, different) * tests <= alpha)

    def disclosure(df):
        p = F.col("n_entity") / F.lit(max(total, 1))
        pmi = F.log2(F.col("n_both") * F.lit(float(max(total, 1))) / (F.col("n_entity") * df))
        return F.when(p < 1, pmi / -F.log2(p)).otherwise(F.lit(0.0))

    # a term is in as many texts as it has near any entity at least: pairs of one text that fail
    # even so go; those of more stay at any size of the corpus, so they grow as it does
    pairs = cut_lineage(met.where(((F.col("both") >= 2) | enough(F.col("near_texts")))
                                  & (disclosure(F.col("n_near")) >= threshold)))
    df = document_frequency(docs, cut_lineage(_slots(pairs.select("term").distinct())))
    # rows with the term, the copies of texts that have it near an entity counted once
    term_texts = F.least(different, F.greatest("near_texts", F.col("df") - F.col("n_near") + F.col("near_texts")))
    return (pairs.join(df, "term").where(enough(term_texts)).withColumn("disclosure", disclosure(F.col("df")))
            .where(F.col("disclosure") >= threshold).select("entity", "term", "disclosure"))


def _order(spans):
    rank = F.array(*[F.lit(k) for k in KINDS])
    return F.transform(F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.array_position(rank, s["kind"]).alias("rank"),
        s["end"].alias("end"), s["kind"].alias("kind")))),
        lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def personal_spans(docs: DataFrame, reach: int = REACH, support: int = SUPPORT,
                   threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, key, base, spans) of every row of ``docs`` (doc_id, text; other columns are
    ignored): the base spans, and all spans with those of disclosing terms, as arrays of
    (kind, start, end) in code points, end exclusive, by start and kind.  ``key`` hashes the
    text.  Null and empty texts have no spans; null doc_ids stay; repeated rows get equal rows
    and count as documents each, but as one text for ``support`` and chance; an empty table gives
    none."""
    docs = bounded_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                                        F.xxhash64("text").alias("key"))
    ship_package(docs.sparkSession)
    found = cut_lineage(find_base(docs, reach))
    flagged = disclosing_terms(docs, found, support, threshold)
    near = (found.where(F.size("contexts") > 0).groupBy("key").agg(F.first("contexts").alias("contexts"))
            .select("key", F.explode("contexts").alias("c")).select("key", "c.*"))
    added = (near.join(flagged, ["entity", "term"]).select("key", "start", "end").distinct()
             .groupBy("key").agg(F.collect_list(F.struct(F.lit("term").alias("kind"), "start", "end")).alias("added")))
    return (found.select("doc_id", "key", "base").join(added, "key", "left")
            .select("doc_id", "key", "base",
                    F.when(F.col("added").isNull(), F.col("base"))
                    .otherwise(_order(F.concat("base", F.coalesce("added", F.array().cast(f"array<{_SPAN}>")))))
                    .alias("spans")))


def span_string(spans):
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_kind(spans, kind: str):
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def redact(text: str, spans: list[dict]) -> str:
    """``text`` with base spans as ``<KIND>``, numeric terms generalised to ``<NUMBER>`` and
    other terms removed; where spans overlap the one that starts first counts."""
    out, at = [], 0
    for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
        if s["start"] < at:
            if s["end"] > at and s["kind"] != "term":
                at = s["end"]
            continue
        word = text[s["start"]:s["end"]]
        out.append(text[at:s["start"]])
        out.append(f"<{s['kind'].upper()}>" if s["kind"] != "term" else
                   "<NUMBER>" if word.isdigit() else "")
        at = s["end"]
    return "".join(out) + text[at:]


def sanitised(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with personal data and disclosing terms replaced in ``text``; rows and other
    columns stay, texts without spans are returned unchanged."""
    spans = (personal_spans(docs, **options).where(F.size("spans") > 0)
             .dropDuplicates(["key"]).select(F.col("key").alias("_key"), F.col("spans").alias("_spans")))
    # a struct, so that no column of ``docs`` can clash with those made here
    joined = docs.select(F.struct(*docs.columns).alias("doc"), F.xxhash64("text").alias("_key")).join(spans, "_key", "left")

    @F.pandas_udf("string")
    def clean(text, found):
        import pandas as pd
        return pd.Series([t if s is None or t is None else redact(t, list(s)) for t, s in zip(text, found)],
                         dtype=object)

    text = F.when(F.col("_spans").isNull(), F.col("doc.text")).otherwise(clean("doc.text", "_spans"))
    return joined.select(*(text.alias(c) if c == "text" else F.col("doc")[c].alias(c) for c in docs.columns))
