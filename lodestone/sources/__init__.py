"""Sources and sinks: driver tables, landed JSON envelopes, batch inputs, versioned tables."""

from .tables import DRIVER_TABLES, Tables, read_table

__all__ = ["DRIVER_TABLES", "Tables", "read_table"]
