"""Readers: CSV reports, preamble grids, workbooks, JSON payloads, pages, seeds."""
