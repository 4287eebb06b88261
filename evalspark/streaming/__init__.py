"""Bounded-memory incremental passes."""
