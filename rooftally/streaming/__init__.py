from .incremental import run_available

__all__ = ["run_available"]
