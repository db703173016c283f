"""Readers and writers: zones, catalog, relational stores, inventories, documents, event streams."""

from lakewarden.sources.catalog import register_dataset
from lakewarden.sources.documents import flatten_documents
from lakewarden.sources.events import parse_messages, read_event_stream, read_message_stream, write_parsed
from lakewarden.sources.inventory import object_inventory
from lakewarden.sources.relational import read_jdbc, write_jdbc
from lakewarden.sources.zones import read_zone, write_zone, zone_path

__all__ = [
    "flatten_documents",
    "object_inventory",
    "parse_messages",
    "read_event_stream",
    "read_jdbc",
    "read_message_stream",
    "read_zone",
    "register_dataset",
    "write_jdbc",
    "write_parsed",
    "write_zone",
    "zone_path",
]
