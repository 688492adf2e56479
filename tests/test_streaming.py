import uuid

from revlens.operators.preprocess import review_features
from revlens.streaming.features import stream_features, write_stream


def test_stream_gives_the_batch_features(spark, tmp_path):
    rows = [(i, float(i % 5 + 1), f"Not good {i}!", "s", "06 3, 2014") for i in range(20)]
    batch = spark.createDataFrame(rows, "id bigint, overall double, reviewText string, summary string, reviewTime string")
    batch.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(batch.schema).parquet(str(tmp_path / "in"))
    query = write_stream(stream_features(stream), str(tmp_path / "out"), name=uuid.uuid4().hex)
    assert query.awaitTermination(120)
    wanted = review_features(batch).drop("reviewer_freq")
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == 20
    assert got.select(*wanted.columns).exceptAll(wanted).count() == 0
