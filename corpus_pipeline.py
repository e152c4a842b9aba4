"""The training-data pipeline's stages; see ``credtrail.llm.pipeline``."""

from credtrail.llm.pipeline import (NAMELESS, ORACLE_SQL, STAGES, bpe, decontamination, language_id, near_dedup, run,  # noqa: F401
                                    toxicity)
