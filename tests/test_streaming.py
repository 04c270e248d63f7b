from pairloom.streaming.chain import mark_and_tokenize


def test_chain_gives_the_same_on_a_stream(spark, tmp_path):
    rows = [(i, f"Question {i} " + "x" * 200, "And, answer?", i % 2) for i in range(20)]
    pairs = spark.createDataFrame(rows, "pair_id long, question1 string, question2 string, is_duplicate int")
    pairs.write.parquet(f"{tmp_path}/in")
    stream = mark_and_tokenize(spark.readStream.schema(pairs.schema).parquet(f"{tmp_path}/in"))
    run = stream.writeStream.format("memory").queryName("chain").outputMode("append").option(
        "checkpointLocation", f"{tmp_path}/check").trigger(availableNow=True).start()
    run.awaitTermination(120)
    streamed = spark.table("chain").orderBy("pair_id").collect()
    assert streamed == mark_and_tokenize(pairs).orderBy("pair_id").collect()
    assert all(len(r["text"].split("] ")[1]) == 155 for r in streamed)
