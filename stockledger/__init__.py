"""Operational reporting on Spark DataFrames.

``functions``  column expressions (text, dates, code labels, units)
``operators``  reusable DataFrame operators (running scans, as-of lookups, joins, pivots)
``sources``    the table catalog, table schemas and the demo binding
``plans``      the reports, each ``report(catalog, **params) -> DataFrame``
``cases``      every operator and report bound to the test tables, with its check SQL
"""

from stockledger.sources.catalog import Catalog

__all__ = ["Catalog"]
