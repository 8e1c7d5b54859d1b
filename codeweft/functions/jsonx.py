"""JSON text: canonical form, digests and progress offsets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical_json(fields: dict[str, Column]) -> Column:
    """Compact JSON object with its keys in name order and nulls kept."""
    ordered = [fields[name].alias(name) for name in sorted(fields)]
    return F.to_json(F.struct(*ordered), {"ignoreNullFields": "false"})


def json_hash(fields: dict[str, Column]) -> Column:
    return F.sha2(canonical_json(fields), 256)


def progress_offset(offset: Column, topic: str, partition: str = "0") -> Column:
    """Offset of one partition, from an object or from JSON text of it.

    Progress rows hold either ``{"topic":{"0":16}}`` or the same as a quoted
    string, so a quoted one is unwrapped first.
    """
    unwrapped = F.coalesce(
        F.get_json_object(F.concat(F.lit('{"v":'), offset, F.lit("}")), "$.v"), offset
    )
    found = F.get_json_object(unwrapped, f"$['{topic}']['{partition}']")
    return found.cast("bigint")
