"""Scans of landed feed files and flatteners that map them onto the article schema."""
