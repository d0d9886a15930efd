"""The near-duplicate stage joins by SimHash and by similar sets, and keeps chains through both."""

import corpus_pipeline
from abundara.llm.simhash import simhash


def test_near_duplicates_by_simhash(spark):
    line = "buy cheap gold now friends "
    words = lambda tag, n: " ".join(f"{tag}{k}" for k in range(n))
    one, two = line * 300 + words("left", 30), line * 300 + words("right", 30)
    three = line * 4 + words("right", 30)  # the shingles of two, but for a few, in other numbers
    far = words("other", 40)
    assert (simhash(one.encode()) ^ simhash(two.encode())).bit_count() <= 2 < (simhash(two.encode()) ^ simhash(three.encode())).bit_count()
    rows = [(1, three), (2, one), (3, two), (4, far), (None, one), (5, None), (6, "")]
    kept = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()
    # 2 and 3 share a fingerprint, 1 and 3 their five-word sets; the row without an id stays
    assert sorted((r.doc_id or 0) for r in kept) == [0, 1, 4, 5]
