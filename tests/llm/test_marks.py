import test_packing

from shelfwise.llm import packing


def test_capitals_that_compose_only_when_small(spark):
    pairs = ["H̱", "J̌", "T̈", "T̈́", "W̊", "Y̊", "T᷂̈"]
    texts = [*pairs, " ".join(f"HE {p}AN Mixed" for p in pairs), "<|ENDOFTEXT|> J̌AN"]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    test_packing.check(rows, packing.packed_documents(docs, test_packing.PATH).collect())
