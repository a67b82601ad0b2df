"""Session settings the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# UTC keeps timestamp arithmetic free of daylight-saving jumps; the AQE settings are Spark's
# defaults, stated because the joins here depend on them.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def get_spark(
    app: str = "sparkprep", master: str | None = None, options: dict[str, str] | None = None
) -> SparkSession:
    """Build or fetch the session; ``master`` stays unset on a cluster, where the launcher names it."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(options or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def s3a_options(
    access_key: str | None = None,
    secret_key: str | None = None,
    endpoint: str | None = None,
    region: str | None = None,
) -> dict[str, str]:
    """Session options for ``s3a://`` paths.

    Only the given values are set. With no key pair Hadoop's default credential chain applies, so
    secrets need not pass through the application at all.
    """
    if bool(access_key) != bool(secret_key):
        raise ValueError("access_key and secret_key must be given together")
    given = {
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.endpoint.region": region,
    }
    return {key: value for key, value in given.items() if value}
