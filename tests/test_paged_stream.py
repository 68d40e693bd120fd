"""Incremental reads of a paged service: nothing lost and nothing twice, over restarts."""

from caudal.sources import paged


def test_a_restarted_query_goes_on(spark, tmp_path):
    log = tmp_path / "n"
    latest = lambda at=str(log): int(open(at).read())
    fetch = lambda offset, limit, filters: [{"id": i, "name": f"n{i}"} for i in range(offset, offset + limit)]
    spark.dataSource.register(paged.PagedSource)
    for n in (0, 25, 25, 61):
        log.write_text(str(n))
        stream = spark.readStream.format("paged").schema("id long, name string").options(fetcher=paged.as_option(fetch), latest=paged.as_option(latest), page="10").load()
        query = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        query.awaitTermination()
        got = spark.read.schema("id long, name string").parquet(str(tmp_path / "out")).collect() if n else []
        assert sorted(r.id for r in got) == list(range(n)) and all(r.name == f"n{r.id}" for r in got)
    reader = paged.PagedStream(None, {"page": "10"})
    assert [(p.offset, p.limit) for p in reader.partitions({"at": 25}, {"at": 48})] == [(25, 10), (35, 10), (45, 3)]
