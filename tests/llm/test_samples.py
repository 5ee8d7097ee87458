from pyspark.sql import functions as F

from roadflux.llm.samples import smallest


def test_smallest(spark):
    frame = spark.range(5000).withColumn("h", F.xxhash64("id"))
    want = sorted((r.h, r.id) for r in frame.collect())
    for most in (1, 50, 2000, 9000):
        got = smallest(frame, F.col("h"), most, 5000, "id").collect()
        assert sorted((r.h, r.id) for r in got) == want[:most]
    assert smallest(frame.limit(0), F.col("h"), 5, 0, "id").count() == 0
