"""Readers, landing, sinks and the fixture derivation."""
