"""Raster-tile analytics expressed as Spark plans."""
