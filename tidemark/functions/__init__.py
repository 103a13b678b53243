"""Column expressions shared by the operators."""

from tidemark.functions.parse import text_field, utc_now, utc_timestamp, whole_number

__all__ = ["text_field", "utc_now", "utc_timestamp", "whole_number"]
