"""Relational operators: pairing, deduplication, decontamination, splits, turns, sections, scoring, histories."""
