import hypothesis.strategies as st
from hypothesis import given, settings
from pyspark.sql import functions as F

from ingot.functions.text import with_index_entries, with_inverted_index, with_reconstructed_text

_token = st.text(alphabet="abc é\n-", min_size=0, max_size=4).filter(lambda t: " " not in t)


def test_index_entries(spark):
    df = spark.createDataFrame([("we can we go",)], "t string")
    e = with_index_entries(df, "t", "e").first()["e"]
    assert [(x["word"], list(x["positions"])) for x in e] == [("can", [1]), ("go", [3]), ("we", [0, 2])]


@settings(max_examples=6, deadline=None)
@given(st.lists(st.lists(_token, min_size=1, max_size=30), min_size=1, max_size=25))
def test_roundtrip_property(spark, docs):
    """reconstruct(index(text)) == text for any token sequence split on single spaces."""
    texts = [" ".join(d) for d in docs]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    ix = with_inverted_index(df, "t", "m").withColumn("j", F.to_json("m"))
    back = with_reconstructed_text(ix, "j", "r").select("i", "r").collect()
    assert {r["i"]: r["r"] for r in back} == dict(enumerate(texts))
