"""Warehouse pipelines, table reconciliation and pipeline catalogues as Spark jobs."""
