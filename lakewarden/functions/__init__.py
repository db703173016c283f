"""Column expressions: no rows leave the JVM."""

from lakewarden.functions.columns import (
    canonical_name,
    deterministic_id,
    fill_template,
    host_prefix,
    ipv4_to_long,
    mask_expression,
    merge_maps,
    resource_id_parts,
    storage_name,
)

__all__ = [
    "canonical_name",
    "deterministic_id",
    "fill_template",
    "host_prefix",
    "ipv4_to_long",
    "mask_expression",
    "merge_maps",
    "resource_id_parts",
    "storage_name",
]
