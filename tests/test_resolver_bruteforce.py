"""The native resolver equals a brute-force Python resolver (no prune) on random values."""

from hypothesis import given, settings, strategies as st

from tallyspark.config import DEFAULT
from tallyspark.functions.fuzzy import token_sort_ratio_py
from tallyspark.operators import category
from tallyspark.plans.synth import CAT_WORDS, PAY_WORDS


def brute(value, s=DEFAULT):
    if value is None:
        return s.manual_label
    v = value.strip().lower()
    labels = category.label_table(s)
    for l in labels:
        if l.norm == v:
            return l.label
    hits = [l for l in labels if l.norm and l.norm in v]
    if hits:
        return max(hits, key=lambda l: (len(l.label), -l.ord)).label
    scored = [(token_sort_ratio_py(v, l.norm), -l.ord, l.label) for l in labels]
    best = max(scored)
    return best[2] if best[0] >= s.fuzzy_threshold else s.manual_label


alphabet = "abcdefgimnorstuy "
values = st.one_of(st.text(alphabet=alphabet, max_size=16),
                   st.sampled_from([w for w in CAT_WORDS + PAY_WORDS]))


@settings(max_examples=25, deadline=None)
@given(st.lists(values, min_size=1, max_size=40, unique=True))
def test_native_equals_bruteforce(spark, vals):
    df = spark.createDataFrame([(v,) for v in vals], "raw_category string")
    got = {r.raw_category: r.SubCategory for r in category.create_subcategory(df, DEFAULT).collect()}
    for v in vals:
        assert got[v] == brute(v), v


def test_vocabulary_and_near_misses(spark):
    vals = list(CAT_WORDS + PAY_WORDS) + ["restaurnts", "movis", "grocry", "salon", "salons x",
                                          "cred card", "", "   ", "taxi", "intrest rent"]
    df = spark.createDataFrame([(v,) for v in vals], "raw_category string")
    got = {r.raw_category: r.SubCategory for r in category.create_subcategory(df, DEFAULT).collect()}
    assert {v: got[v] for v in vals} == {v: brute(v) for v in vals}
