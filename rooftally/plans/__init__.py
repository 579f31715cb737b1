from .nightly import NightlyResult, NightlyStages, nightly_stages, run_nightly
from .rawview import raw_feed, raw_listings, raw_sources

__all__ = ["NightlyResult", "NightlyStages", "nightly_stages", "run_nightly", "raw_feed", "raw_listings", "raw_sources"]
