"""Whole questions: cards, reports, attribution, checks, insights, backfill."""
