"""Copy a collection from any Spark data source into Parquet."""

from pyspark.sql import SparkSession


def extract_to_lake(
    spark: SparkSession, fmt: str, options: dict, out: str, schema=None
) -> None:
    """Read ``fmt`` with ``options`` and overwrite the Parquet table at ``out``.

    For a document store pass the connector's format name and options; its jar is
    put on the class path by whoever submits the job. With ``schema`` the source is
    not read an extra time to infer one.
    """
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    reader.load().write.mode("overwrite").option("compression", "snappy").parquet(out)
