"""chanlake: PySpark tables, links and scores for archives of public messaging channels."""

from chanlake.session import configure, create_session

__all__ = ["configure", "create_session"]
