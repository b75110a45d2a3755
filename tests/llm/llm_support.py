"""Shared by the tests of the training-data operators."""
SF = "/root/testdata/sf0.001"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)
