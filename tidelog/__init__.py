"""tidelog: change-data-capture analytics as Spark DataFrame jobs."""

from tidelog.session import prepare

__all__ = ["prepare"]
