"""Readers, writers, staging projections and fixture adapters."""
