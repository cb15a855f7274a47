"""Object listings and the S3A connection settings.

Listing uses Spark's ``binaryFile`` source with only path and length
selected, so file contents are never read; the listing itself is
distributed like any other file scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_objects(spark: SparkSession, root: str, suffix: str | None = ".parquet") -> DataFrame:
    """Recursive listing: path, length, modification time (optionally by suffix)."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if suffix:
        r = r.option("pathGlobFilter", f"*{suffix}")
    return r.load(root).select("path", "length", "modificationTime")


def table_has_files(listing: DataFrame) -> DataFrame:
    """One row: does the table root hold any data file?"""
    return listing.limit(1).agg((F.count(F.lit(1)) > 0).alias("has_files"))


def s3a_options(endpoint: str, access_key: str, secret_key: str, path_style: bool = True,
                ssl: bool = False, max_connections: int = 100, fast_upload_buffer: str = "disk",
                extra: dict | None = None) -> dict[str, str]:
    """``spark.hadoop.fs.s3a.*`` settings for an S3-compatible store.

    Credentials are parameters, never defaults.  Needs the hadoop-aws jar on
    the classpath; it is not part of this environment, so only the option
    map is tested here.
    """
    opts = {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(ssl).lower(),
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.aws.credentials.provider":
            "org.apache.hadoop.fs.s3a.SimpleAWSCredentialsProvider",
        "spark.hadoop.fs.s3a.connection.maximum": str(max_connections),
        "spark.hadoop.fs.s3a.fast.upload": "true",
        "spark.hadoop.fs.s3a.fast.upload.buffer": fast_upload_buffer,
    }
    opts.update(extra or {})
    return opts
