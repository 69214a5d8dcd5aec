"""Live-event analytics on Spark: chat, streams and donations as DataFrames."""

from streamtally.plans.models import Models
from streamtally.settings import Settings

__all__ = ["Models", "Settings"]
