"""lakeops: DataFrame operators and composed jobs for layered data lakes."""

from lakeops.session import configure, materialise, new_scratch, session

__all__ = ["configure", "materialise", "new_scratch", "session"]
