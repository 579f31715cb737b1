from .documents import DocumentWriter, LoaderStats, load_documents
from .warehouse import WarehouseStats, append_to_warehouse, table_id

__all__ = [
    "DocumentWriter", "LoaderStats", "load_documents",
    "WarehouseStats", "append_to_warehouse", "table_id",
]
