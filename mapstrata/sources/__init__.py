"""Sources: GeoPackage files, and the manifest of archives behind them."""

from pyspark.sql import SparkSession


def register(spark: SparkSession) -> None:
    """Make ``spark.read.format("gpkg")`` known to the session."""
    from mapstrata.sources.gpkg import GpkgDataSource

    spark.dataSource.register(GpkgDataSource)
