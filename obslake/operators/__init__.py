"""Relational operators over readings: flatten, first-wins dedupe, batch
completeness, splits and grading metrics."""
