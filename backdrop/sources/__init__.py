"""Readers: image folders, capture files, JSON-lines feeds and the views
built from the driver's tables."""
