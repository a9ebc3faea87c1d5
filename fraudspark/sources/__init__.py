"""Readers, the driver-data adapter, tables and sinks."""
