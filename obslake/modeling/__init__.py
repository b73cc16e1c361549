"""Spark ML: the four-stage classifier (ML-1..7), model store (SNK-4,
SRC-4), training metadata (ML-9) and per-batch score reports (ML-8, ML-10)."""
