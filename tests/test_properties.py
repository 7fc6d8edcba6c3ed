"""Property-based checks (hypothesis): key derivation and first-match rule lists."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodestone.functions import slugify
from lodestone.operators import rules as R

NAMES = st.lists(st.one_of(st.none(), st.text(alphabet=st.characters(
    min_codepoint=32, max_codepoint=255, blacklist_categories=("Cs",)), max_size=20)),
    min_size=1, max_size=30)


@settings(max_examples=15, deadline=None)
@given(NAMES)
def test_slugify_matches_python(spark, names):
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string")
    got = {r.i: r.s for r in df.select("i", slugify("n").alias("s")).collect()}
    assert all(got[i] == ("" if n is None else n.lower().replace(" ", "_"))
               for i, n in enumerate(names))


ROWS = st.lists(st.tuples(st.one_of(st.none(), st.integers(-5, 5)),
                          st.one_of(st.none(), st.integers(-5, 5))), min_size=1, max_size=25)


@settings(max_examples=15, deadline=None)
@given(ROWS)
def test_first_failing_rule_wins(spark, rows):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(rows)], "i int, a int, b int")
    rules = [("A_NEG", F.col("a") < 0), ("B_NEG", F.col("b") < 0), ("SUM_BIG", F.col("a") + F.col("b") > 6)]
    got = {r.i: r[R.REASON] for r in df.select("i", R.first_failing(rules).alias(R.REASON)).collect()}

    def python(a, b):
        # a NULL condition does not fire
        if a is not None and a < 0:
            return "A_NEG"
        if b is not None and b < 0:
            return "B_NEG"
        if a is not None and b is not None and a + b > 6:
            return "SUM_BIG"
        return None
    assert all(got[i] == python(a, b) for i, (a, b) in enumerate(rows))
