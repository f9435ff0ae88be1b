"""Readers, sinks, catalog registration and layer audits."""
