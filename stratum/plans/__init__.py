"""Whole runs: the layer-by-layer job and the catalog of checked queries."""
