"""Randomized comparisons against small Python oracles (summary A1-A4, strip P8)."""

import datetime as dt
import random
import sys

from lodestone.functions import py_strip
from lodestone.operators import summarize as S


def python_summary(rows):
    """Per key: count, non-empty values by count desc then first position, year span,
    modal category (tie -> latest date, missing date loses, then first position)."""
    out = {}
    for k in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == k), key=lambda r: r[1])
        counts, first = {}, {}
        for _, pos, v, ts, c in mine:
            if v:
                counts[v] = counts.get(v, 0) + 1
                first.setdefault(v, pos)
        values = sorted(counts, key=lambda v: (-counts[v], first[v]))
        years = [ts.year for _, _, _, ts, _ in mine if ts is not None]
        cc, cfirst, clast = {}, {}, {}
        for _, pos, _, ts, c in mine:
            if c:
                cc[c] = cc.get(c, 0) + 1
                cfirst.setdefault(c, pos)
                if ts is not None and (clast.get(c) is None or ts > clast[c]):
                    clast[c] = ts
        mode = None
        if cc:
            best = max(cc.values())
            tied = [c for c in cc if cc[c] == best]
            tied.sort(key=lambda c: (clast.get(c) is not None, clast.get(c) or dt.datetime.min,
                                     -cfirst[c]), reverse=True)
            mode = tied[0]
        out[k] = (len(mine), values, min(years) if years else None,
                  max(years) if years else None, mode)
    return out


def test_summary_random(spark):
    rnd = random.Random(17)
    rows = []
    for pos in range(3000):
        k = rnd.choice(["a", "b", "c", "d", "e"] * 3 + ["hot"] * 15)
        v = rnd.choice(["US", "ZA", "PT", "", None, "AU"])
        ts = None if rnd.random() < 0.2 else dt.datetime(1990 + rnd.randrange(30), 1 + rnd.randrange(12), 1)
        c = rnd.choice(["VU", "NT", "LC", "", None])
        rows.append((k, pos, v, ts, c))
    df = spark.createDataFrame(rows, "k string, pos int, v string, ts timestamp, c string").repartition(7)
    got = {r.k: (r.n_occurrences_validas, r.paises, r.anio_min, r.anio_max, r.iucn_red_list_category)
           for r in S.summarize_observations(df, "k", "pos", "v", "c", "ts").collect()}
    assert got == python_summary(rows)


WHITESPACE = [chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace()]


def test_strip_matches_python(spark):
    rnd = random.Random(3)
    texts = []
    for _ in range(400):
        core = "".join(rnd.choice(["a", "b c", "é", "​", "x\ny"]) for _ in range(rnd.randrange(0, 4)))
        pad = lambda: "".join(rnd.choice(WHITESPACE) for _ in range(rnd.randrange(0, 4)))
        texts.append(pad() + core + pad())
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.s for r in df.select("i", py_strip("t").alias("s")).collect()}
    assert all(got[i] == t.strip() for i, t in enumerate(texts))
