"""The corpus pipeline: its stages, their SQL (none) and the run over ``documents``. The stages are in ``zonecast.llm.pipeline``."""

from zonecast.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["STAGES", "ORACLE_SQL", "run"]
