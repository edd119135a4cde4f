"""Deterministic message and bundle ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the namespace of user-feedback ids.
NAMESPACE_UF = "677aba79-e672-4fe3-91d5-c69306fe025d"


def uuid5(name: Column, namespace: str = NAMESPACE_UF) -> Column:
    """RFC 4122 version 5 id of a text within a namespace."""
    space = F.unhex(F.lit(namespace.replace("-", "")))
    digest = F.sha1(F.concat(space, F.encode(name, "UTF-8")))

    def piece(start: int, length: int) -> Column:
        return F.substring(digest, start, length)

    variant = F.translate(piece(17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat_ws(
        "-",
        piece(1, 8),
        piece(9, 4),
        F.concat(F.lit("5"), piece(14, 3)),
        F.concat(variant, piece(18, 3)),
        piece(21, 12),
    )


def message_uuid(metadata: Column, collection_id: Column) -> Column:
    """Id over the collection id and all metadata values in sorted order; a random id if there is neither value."""
    values = F.array_join(F.array_sort(F.map_values(metadata)), "")
    return F.when(F.length(values) > 0, uuid5(F.concat(F.coalesce(collection_id, F.lit("")), values))).otherwise(F.uuid())


def bundle_uuid(program: Column, deployment: Column, language: Column, index: Column) -> Column:
    """Id of the ``index``-th bundle of a group; the same on every rerun."""
    return uuid5(F.concat_ws("/", *[F.coalesce(c.cast("string"), F.lit("")) for c in (program, deployment, language, index)]))
