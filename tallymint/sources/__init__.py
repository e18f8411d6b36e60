"""Scans: nested JSON files, archives, trees of daily prices, line files and CSV."""
