from lociframe.operators import sites
from lociframe.streaming import sites as streaming


def test_stream_equals_batch(spark, tmp_path):
    schema = "site long, chrom long, pos long, ind long, a long, b long, q long, g long"
    rows = [(s, 0, s, i, s % 3, i % 2, 10 * i, (s + i) % 4 - 1) for s in range(20) for i in range(4)]
    calls = spark.createDataFrame(rows, schema)
    calls.repartition(5).write.parquet(str(tmp_path / "in"))
    for start, batch in ((streaming.running_population, sites.aggregate_population), (streaming.running_allele_counts, sites.allele_counts)):
        name = start.__name__
        start(streaming.watched_calls(spark, str(tmp_path / "in"), schema), (0, 1, 2), str(tmp_path / name), name).awaitTermination()
        key = lambda r: tuple(r)
        assert sorted(map(key, spark.table(name).collect())) == sorted(map(key, batch(calls, (0, 1, 2)).collect()))
