import pandas as pd

from corvane.operators import custom


def test_mapper_may_drop_and_multiply_rows(spark, rows):
    table = spark.createDataFrame([("a b",), ("",), ("c",)], "line string")
    factor = {"times": 2}

    def words(batch):
        tokens = batch["line"].str.split().explode().dropna()
        return pd.DataFrame({"word": tokens, "n": factor["times"]})

    assert rows(custom.map_rows(table, words, "word string, n bigint")) == [("a", 2), ("b", 2), ("c", 2)]
