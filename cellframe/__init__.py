"""Spatial-omics analytics on long (cell, gene, value) tables, as Spark DataFrame operators."""
