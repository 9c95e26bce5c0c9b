"""Rollups, series, KPIs and page numbers."""
