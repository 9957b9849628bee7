import corpus_pipeline
from spendcast.llm.common import shrink_heaps


def collections(spark) -> int:
    """Full collections so far of the Java machine, which is also the executor's on a local master."""
    beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    return sum(b.getCollectionCount() for b in beans if any(x in b.getName() for x in ("Old", "MarkSweep", "Major")))


def test_heaps_are_collected(spark):
    before = collections(spark)
    shrink_heaps(spark)
    assert collections(spark) > before


def test_every_stage_begins_with_a_collection(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a plain text of some words", "en", "x", 26)], "doc_id long, text string, lang string, source string, n_chars int")
    seen = []
    monkeypatch.setattr(corpus_pipeline, "shrink_heaps", seen.append)
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        if n:  # the first one has nothing to learn from here
            stage(spark, docs, "")
            assert len(seen) == n
