"""hirelens: hiring-pipeline integrity and SLA analytics on Spark."""

from hirelens.model import HiringTables
from hirelens.session import build_session

__all__ = ["HiringTables", "build_session"]
