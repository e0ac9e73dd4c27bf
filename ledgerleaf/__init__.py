"""Document intelligence and review workflow on Spark."""

from ledgerleaf.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
