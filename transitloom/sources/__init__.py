"""Landed documents, static schedule files, request sweeps and catalog tables."""
