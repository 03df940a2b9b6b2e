"""Deterministic identifiers."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The DNS namespace of name-based UUIDs and the name of a chunk.
DNS_NAMESPACE = "6ba7b8109dad11d180b400c04fd430c8"
CHUNK_NAME = "article_%d_chunk_%d"


def uuid5(name: Column, namespace: str = DNS_NAMESPACE) -> Column:
    """Version 5 UUID of a name."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace)), F.encode(name, "UTF-8")))
    variant = F.translate(F.substr(digest, F.lit(17), F.lit(1)), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat_ws(
        "-",
        F.substr(digest, F.lit(1), F.lit(8)),
        F.substr(digest, F.lit(9), F.lit(4)),
        F.concat(F.lit("5"), F.substr(digest, F.lit(14), F.lit(3))),
        F.concat(variant, F.substr(digest, F.lit(18), F.lit(3))),
        F.substr(digest, F.lit(21), F.lit(12)),
    )


def point_id(article_id: Column, chunk_index: Column) -> Column:
    """The permanent id of a chunk in the vector collection."""
    return uuid5(F.format_string(CHUNK_NAME, article_id.cast("bigint"), chunk_index.cast("bigint")))
