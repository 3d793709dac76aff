"""Wiring of operators into the pricing lineage."""
