from docpipe.sources import vector_store
from docpipe.streaming.append import index_stream


def test_batches_are_appended(spark, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "index")
    for n in range(2):
        docs = spark.createDataFrame([(f"{n}.md", f"# one {n}\n\ntwo")], "source_path string, text string")
        docs.write.mode("append").parquet(source)
        stream = spark.readStream.schema(docs.schema).parquet(source)
        query = (index_stream(stream, path).option("checkpointLocation", str(tmp_path / "state"))
                 .trigger(availableNow=True).start())
        assert query.awaitTermination(60)
        assert vector_store.count_rows(spark, path) == n + 1
    assert {r["id"] for r in vector_store.open_table(spark, path).collect()} == {"0.md_0", "1.md_0"}
