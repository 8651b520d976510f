import random

from shelfwise.llm import quality


def test_junk_with_a_language_of_its_own_is_no_reference(spark):
    rng = random.Random(3)
    common = "the of and a to in is was it for on with as by at from that this are".split()
    plain = [" ".join(rng.choice([*common, "house", "river", "stone."]) for _ in range(300)) for _ in range(30)]
    junk = [" ".join("".join(rng.choice("#$%&X7") for _ in range(6)) for _ in range(300)) for _ in range(3)]
    rows = [(i, t, "en") for i, t in enumerate(plain)]
    rows += [(100, junk[0], "xx"), (101, junk[1], "en"), (102, junk[2], None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r.doc_id for r in quality.assess(docs).where("kept").collect()}
    assert kept == set(range(30))


def test_references_are_bounded(spark):
    """A language of its own in every document: none is collected, the large ones are."""
    rows = [(i, f"w{i} and the rest of it", f"l{i}") for i in range(500)]
    rows += [(1000 + i, "the same words " * 100, "big") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    least = quality.REFERENCE_DOCUMENTS, quality.REFERENCE_WORDS
    assert [r["lang"] for r in quality.reference(docs, 50, *least)] == ["big"]
    assert {r["lang"] for r in quality.reference(docs, 50, most=2)} == {"big", "l0"}
    assert quality.assess(docs).count() == len(rows)
