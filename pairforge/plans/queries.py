"""Import every query module so the registry is complete."""

from pairforge.plans import catalog  # noqa: F401
from pairforge.plans import q_artifacts, q_eval, q_exact, q_files, q_pairs, q_streams, q_text, q_tokens  # noqa: F401
from pairforge.plans.catalog import REGISTRY

__all__ = ["REGISTRY"]
