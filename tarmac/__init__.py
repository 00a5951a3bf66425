"""tarmac: airport operations analytics as Spark jobs."""

from tarmac.config import Thresholds
from tarmac.session import build_session, scratch_dir

__all__ = ["Thresholds", "build_session", "scratch_dir"]
