from stockledger.sources.catalog import Catalog
from stockledger.sources.layout import write_by_month

__all__ = ["Catalog", "write_by_month"]
