"""obslake: keyed batches of sensor-style readings on Spark.

A lake of JSON documents (one per batch key and source) is scanned with a
declared schema, flattened, labelled from file provenance, filtered to
complete batches, loaded exactly once per key into a flat table (batch or
Structured Streaming), used to train a Spark ML classifier that predicts the
source of a reading, and graded into per-batch reports.

Everything is DataFrame / Spark ML / Structured Streaming; see README.md.
"""

__version__ = "0.1.0"
