"""The corpus pipeline: STAGES, run and ORACLE_SQL (rollweave.llm.pipeline)."""

from rollweave.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
