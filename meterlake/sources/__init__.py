"""Readers for landed reports, exports, logs and tables.

Every reader declares its schema (nothing is inferred) and fails on malformed
input instead of dropping it. Each is split into ``read_x`` (files) and a
function from raw rows to fact rows, so that the same code serves batch files,
streams and derived data.
"""
