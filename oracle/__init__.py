"""Independent SQL for every query, run by another engine on the same tables."""

from oracle.compose import compose

__all__ = ["compose"]
