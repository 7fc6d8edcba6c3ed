"""lodestone: a Spark-native engine for building and querying a document knowledge base.

Layers (all DataFrame -> DataFrame):

* ``sources``    landed JSON envelopes, batch inputs, versioned Parquet tables
* ``functions``  column expressions (keys, dates, numbers, JSON tests, text helpers)
* ``operators``  validation with quarantine, N->1 summaries, pivot merge, keyed upsert,
                 section chunking, embedding and filtered nearest-neighbour search
* ``plans``      whole-batch pipeline and the registered queries on the driver tables
* ``streaming``  incremental landing with Structured Streaming
"""

__version__ = "0.1.0"
