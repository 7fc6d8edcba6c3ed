"""Sections and chunks (FIXTURES 2.7) and a randomized check against a Python splitter."""

import random
import re

from lodestone.operators import sections as SEC

SCHEMA = ("species_key string, wikipedia_title string, sections_text string, "
          "taxonomy_status string, kingdom string, phylum string, class_name string, rank string")
FULL = ("Intro dropped\n== Description and morphology ==\nBig.\n== Distribution and habitat ==\n"
        "Oceans.\n== Behavior ==\nSwims.\n== Diet and feeding ==\nSeals.\n== Reproduction ==\nEggs.\n"
        "== Conservation status ==\nVU.\n== Human interaction ==\nBites.\n== References ==\nR\n"
        "== Gallery ==\nPics\n== Etymology ==\nGreek")


def parents(spark, rows):
    return {r.species_key: r.asDict() for r in
            SEC.build_sections(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_fixture_sections_and_chunks(spark):
    rows = [("carcharodon_carcharias", "Great white shark", FULL, "MATCHED", "Animalia", "Chordata",
             "Chondrichthyes", "SPECIES")]
    p = parents(spark, rows)["carcharodon_carcharias"]
    assert p["identity"] == "Species: Great white shark (carcharodon_carcharias)"
    assert p["taxonomy"] == "kingdom: Animalia; phylum: Chordata; class_name: Chondrichthyes; rank: SPECIES"
    assert p["distribution"] == "Oceans." and p["habitat"] is None
    ch = SEC.chunks(SEC.build_sections(spark.createDataFrame(rows, SCHEMA))).collect()
    assert len(ch) == 11
    assert "carcharodon_carcharias__Human Interaction__0" in {c.chunk_id for c in ch}


def test_edge_cases(spark):
    rows = [("e", "T", "", "UNMATCHED", None, None, None, None),
            ("h", "T", "== Habitat ==\nreef\n== Behavior ==\nshy", "UNMATCHED", None, None, None, None),
            ("p", "T", "== Diet ==\n== Prey ==\nfish", "UNMATCHED", None, None, None, None),
            ("b", "T", "== Diet ==\na\n== Prey ==\n\n== Feeding ==\nb", "UNMATCHED", None, None, None, None),
            ("t", "T", "== Taxonomy ==\nfrom text", "MATCHED", None, "", None, None)]
    got = parents(spark, rows)
    assert [k for k, v in got["e"].items() if v and k != "species_key"] == ["identity"]
    assert (got["h"]["habitat"], got["h"]["behavior"]) == ("reef", "shy")
    assert got["p"]["diet"] == "fish"
    assert got["b"]["diet"] == "a\n\nb"
    assert got["t"]["taxonomy"] == "from text"  # matched but every field empty


KEYWORDS = dict(SEC.SECTION_KEYWORDS)


def python_sections(text):
    """Independent line-by-line splitter used as the oracle."""
    pat = re.compile(r"^==+\s*(.+?)\s*==+")
    cur, content, found = None, [], {}

    def close():
        if cur and content:
            sl = cur.strip().lower().strip()
            sec = next((s for s, kws in KEYWORDS.items() if any(k in sl for k in kws)), None)
            if sec:
                found.setdefault(sec, []).append("\n".join(content).strip())
    for line in text.split("\n"):
        m = pat.match(line)
        if m:
            close()
            cur, content = m.group(1), []
        elif cur:
            content.append(line)
    close()
    out = {}
    for s, blocks in found.items():
        c = "\n".join(blocks).strip()
        if c and s not in ("Identity",):
            out[s] = c
    return out


def test_random_documents_against_python(spark):
    rnd = random.Random(11)
    heads = ["Diet", "Prey and food", "Habitat", "Range", "Etymology", "Human", "=x", "Status",
             "Gallery", "Life cycle", "Taxonomy"]
    rows, texts = [], {}
    for i in range(300):
        lines = []
        for _ in range(rnd.randrange(0, 12)):
            r = rnd.random()
            if r < 0.35:
                lvl = "=" * rnd.randrange(2, 4)
                lines.append(f"{lvl} {rnd.choice(heads)} {lvl}")
            elif r < 0.45:
                lines.append(rnd.choice(["", "  ", "\t"]))
            else:
                lines.append(rnd.choice(["alpha", " beta ", "gamma delta", "x=y", "== not"]))
        texts[f"k{i}"] = "\n".join(lines)
        rows.append((f"k{i}", "T", texts[f"k{i}"], "UNMATCHED", None, None, None, None))
    got = parents(spark, rows)
    for k, text in texts.items():
        want = python_sections(text)
        have = {s: got[k][SEC.section_column(s)] for s in SEC.CANONICAL_SECTIONS
                if s != "Identity" and got[k][SEC.section_column(s)] is not None}
        assert have == want, (k, text)
