"""pairforge: build and audit preference data for language models with Spark DataFrames.

Every operator is a function from DataFrame(s) to DataFrame, expressed with built-in
Spark SQL expressions wherever the semantics allow.  Model calls (generation, judging,
tokenising with a learned vocabulary) are pluggable hooks that run inside
``mapInPandas`` so Spark partitions and schedules them like any other stage.
"""

from pairforge.session import ensure_checkpoint_dir, get_session

__all__ = ["ensure_checkpoint_dir", "get_session"]
__version__ = "0.1.0"
