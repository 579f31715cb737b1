from .landing import ordered_union, scan_json, scan_table, source_counts, with_sequence

__all__ = ["ordered_union", "scan_json", "scan_table", "source_counts", "with_sequence"]
