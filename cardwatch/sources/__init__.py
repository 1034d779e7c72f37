"""Readers: raw text, headed CSV, feature tables and message streams."""
