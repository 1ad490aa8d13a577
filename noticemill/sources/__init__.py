"""Sheets, page tables, JSON envelopes, logs and the star schema as notices."""
