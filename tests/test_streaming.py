"""The cleaning operators are stateless and run unchanged on a stream."""

import os

from tablestats import clean_table
from tests_helpers import RAW_ROWS, RAW_SCHEMA


def test_clean_table_on_stream(spark, tmp_out):
    src = os.path.join(tmp_out, "in")
    spark.createDataFrame(RAW_ROWS, RAW_SCHEMA).write.parquet(src)
    stream = spark.readStream.schema(RAW_SCHEMA).parquet(src)
    cleaned = clean_table(stream)
    assert cleaned.isStreaming
    out = os.path.join(tmp_out, "out")
    q = (cleaned.writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", os.path.join(tmp_out, "ckpt")).trigger(availableNow=True).start())
    q.awaitTermination(120)
    got = spark.read.parquet(out).orderBy("price").collect()
    assert [r.price for r in got] == [None, 9.99, 1299.5]
