"""Adapters: landed payload rows to canonical record envelopes."""
