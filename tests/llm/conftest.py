import pytest
from pyspark.sql import SparkSession
from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCS = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()), StructField("source", StringType()), StructField("n_chars", LongType())])


@pytest.fixture
def documents(spark: SparkSession):
    """A table of documents out of (doc_id, text), with columns that operators might use for themselves."""

    def build(rows, **extra):
        data = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
        df = spark.createDataFrame(data, DOCS).repartition(3)
        from pyspark.sql import functions as F

        return df.withColumns({c: F.lit(v) for c, v in extra.items()})

    return build
