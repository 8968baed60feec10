"""The corpus pipeline of noticeloom.llm, where the driver looks for it."""

from noticeloom.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
