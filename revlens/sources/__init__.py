"""Readers, schemas and the fixture adapters over the driver tables."""
