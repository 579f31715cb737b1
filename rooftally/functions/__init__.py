from .cells import Cell, cell_of, missing_cell
from .coerce import clean_floor, clean_price, clean_rooms, clean_size, clean_text, scalar_text
from .identity import fingerprint, float_text, price_bucket
from .screening import outlier_reason, spam_reason

__all__ = [
    "Cell", "cell_of", "missing_cell",
    "clean_floor", "clean_price", "clean_rooms", "clean_size", "clean_text", "scalar_text",
    "fingerprint", "float_text", "price_bucket",
    "outlier_reason", "spam_reason",
]
