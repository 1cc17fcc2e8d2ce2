"""Importing this module registers every query."""

from martlens.plans import ingest, reports, timeline

MODULES = (reports, ingest, timeline)
