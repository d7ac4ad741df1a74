"""Spark frames of the random source tables."""

from basketseq import schemas
from basketseq.sources.files import SourceTables


def source_tables(spark, source) -> SourceTables:
    return SourceTables(
        orders=spark.createDataFrame(source["orders"], schemas.ORDERS),
        products=spark.createDataFrame(source["products"], schemas.PRODUCTS),
        prior=spark.createDataFrame(source["prior"], schemas.ORDER_PRODUCTS),
        train=spark.createDataFrame(source["train"], schemas.ORDER_PRODUCTS),
    )
