"""Settings for an S3-compatible object store."""

from __future__ import annotations


def s3a_settings(endpoint: str, access_key: str, secret_key: str, ssl: bool = False) -> dict:
    """Session settings for paths that start with ``s3a://``, addressed by path."""
    prefix = "spark.hadoop.fs.s3a."
    return {
        prefix + "endpoint": endpoint,
        prefix + "access.key": access_key,
        prefix + "secret.key": secret_key,
        prefix + "path.style.access": "true",
        prefix + "impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        prefix + "connection.ssl.enabled": str(ssl).lower(),
    }
