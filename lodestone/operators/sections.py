"""Documents -> canonical sections -> chunks.

Row-local (narrow) transformations only: a document is split at heading lines
with one regex ``split``; each block's heading is mapped to a canonical section
by keyword containment; same-section blocks are joined.  No explode is needed
until the final unpivot into chunks, and nothing is shuffled.
Whole texts are processed, never prefixes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import chunk_id, identity_text, labelled_join, py_strip
from ..functions.text import WS_CLASS

# Canonical sections in output order, and the heading keywords of
# each.  The first section (in this order) with a keyword contained in the
# lower-cased heading wins; a heading matching none is dropped.
SECTION_KEYWORDS: list[tuple[str, list[str]]] = [
    ("Identity", ["identity"]),
    ("Taxonomy", ["taxonomy", "classification"]),
    ("Morphology", ["morphology", "description", "anatomy", "appearance"]),
    ("Distribution", ["distribution", "range", "geographic"]),
    ("Habitat", ["habitat"]),
    ("Behavior", ["behavior", "behaviour"]),
    ("Diet", ["diet", "feeding", "food", "prey", "foraging"]),
    ("Reproduction", ["reproduction", "breeding", "mating", "life cycle"]),
    ("Conservation", ["conservation", "threats", "endangered", "status", "population"]),
    ("Human Interaction", ["human interaction", "shark attack", "human"]),
    ("References", ["references", "citations", "further reading", "external links"]),
    ("Multimedia", ["multimedia", "gallery", "media"]),
]
CANONICAL_SECTIONS = [s for s, _ in SECTION_KEYWORDS]


def section_column(section: str) -> str:
    """Column name of a canonical section (``Human Interaction`` -> ``human_interaction``)."""
    return section.lower().replace(" ", "_")


SECTION_COLUMNS = [section_column(s) for s in CANONICAL_SECTIONS]

# A heading line starts with two or more '=', has at least one more character and
# then two or more '=' (anything after them is ignored).  Split before every such line.
_SPLIT_AT_HEADING = r"\n(?=={2,}[^\n]+?={2,})"
_HEADING_TEXT = rf"(?dU)^==+{WS_CLASS}*(.+?){WS_CLASS}*==+"


def canonical_section(heading: Column, normalized: bool = False) -> Column:
    """Heading text -> canonical section name (NULL when no keyword matches).
    ``normalized``: the heading is already stripped and lower-cased."""
    h = heading if normalized else F.lower(py_strip(heading))
    out = F.lit(None).cast("string")
    for section, keywords in reversed(SECTION_KEYWORDS):
        hit = F.lit(False)
        for kw in keywords:
            hit = hit | F.contains(h, F.lit(kw))
        out = F.when(hit, F.lit(section)).otherwise(out)
    return out


def split_at_headings(text: Column) -> Column:
    """The document cut before every heading line; element 0 is the text before the
    first heading."""
    return F.split(F.concat(F.lit("\n"), F.coalesce(text, F.lit(""))), _SPLIT_AT_HEADING, -1)


def heading_blocks(parts: Column) -> Column:
    """``array<struct<section, body>>`` from ``split_at_headings``: one entry per heading,
    in document order (text before the first heading is dropped).  ``body`` is the
    text after the heading line, NULL when the heading has no lines of its own (a
    heading directly followed by another heading, or at the very end).

    Two passes so that each heading is extracted once and the keyword tests read
    the extracted field (expressions inside a lambda are not shared by codegen)."""
    blocks = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))

    def cut(b):
        nl = F.instr(b, "\n")
        first = F.when(nl > 0, F.substr(b, F.lit(1), nl - 1)).otherwise(b)
        return F.struct(F.lower(py_strip(F.regexp_extract(first, _HEADING_TEXT, 1))).alias("h"),
                        F.when(nl > 0, F.substr(b, nl + 1)).alias("body"))
    return F.transform(F.transform(blocks, cut),
                       lambda x: F.struct(canonical_section(x["h"], normalized=True)
                                          .alias("section"), x["body"].alias("body")))


def section_text(blocks: Column, section: str) -> Column:
    """All blocks of one section: each body stripped, joined by newlines, stripped;
    NULL when nothing is left."""
    sel = F.filter(blocks, lambda b: (b["section"] == section) & b["body"].isNotNull())
    joined = F.array_join(F.transform(sel, lambda b: py_strip(b["body"])), "\n")
    return F.nullif(py_strip(joined), F.lit(""))


def build_sections(merged: DataFrame, key: str = "species_key", title: str = "wikipedia_title",
                   text: str = "sections_text", status: str = "taxonomy_status",
                   taxonomy_fields=("kingdom", "phylum", "class_name", "rank")) -> DataFrame:
    """Parent record per key: ``key`` + 12 section columns.

    Identity is always ``Species: {title} ({key})`` (an Identity heading is ignored);
    Taxonomy is ``kingdom: ..; phylum: ..`` over non-empty fields when the taxonomy
    matched, otherwise the Taxonomy heading text."""
    staged = merged.select(F.col(key), F.col(title).alias("_title"),
                           F.col(status).alias("_status"),
                           *[F.col(f).alias(f"_t_{f}") for f in taxonomy_fields],
                           split_at_headings(F.col(text)).alias("_parts"))
    with_blocks = staged.select(*[c for c in staged.columns if c != "_parts"],
                                heading_blocks(F.col("_parts")).alias("_blocks"))
    blocks = F.col("_blocks")
    tax_text = labelled_join([(f, F.col(f"_t_{f}")) for f in taxonomy_fields])
    matched_tax = F.when(F.col("_status") == "MATCHED", tax_text)
    cols = []
    for section in CANONICAL_SECTIONS:
        name = section_column(section)
        if section == "Identity":
            c = identity_text(F.col("_title"), F.col(key))
        elif section == "Taxonomy":
            c = F.coalesce(matched_tax, section_text(blocks, section))
        else:
            c = section_text(blocks, section)
        cols.append(c.alias(name))
    return with_blocks.select(F.col(key), *cols)


def chunks(parents: DataFrame, key: str = "species_key") -> DataFrame:
    """One chunk per populated section in canonical order:
    ``chunk_id = {key}__{Section}__0``, ``section``, stripped ``text``."""
    entries = F.array(*[F.struct(F.lit(i).alias("ord"), F.lit(s).alias("section"),
                                 py_strip(F.col(section_column(s))).alias("text"))
                        for i, s in enumerate(CANONICAL_SECTIONS)])
    exploded = parents.select(F.col(key), F.inline(entries))
    return (exploded.where(F.coalesce(F.length("text"), F.lit(0)) > 0)
            .select(chunk_id(F.col(key).cast("string"), F.col("section")).alias("chunk_id"),
                    F.col(key), "section", "ord", "text"))


def section_coverage(parents: DataFrame, key: str = "species_key") -> DataFrame:
    """Per key: number of populated sections (= number of chunks)."""
    n = sum((F.col(c).isNotNull().cast("int") for c in SECTION_COLUMNS), F.lit(0))
    return parents.select(F.col(key), n.alias("n_sections"))
