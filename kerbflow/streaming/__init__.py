"""Structured Streaming: message encode/parse, rolling statistics, replay, online k-means.

Streams are Kafka-shaped (key, value, topic, partition, offset). On a cluster
the source is ``readStream.format("kafka")``; tests replay the same rows from
Parquet files with ``readStream.format("parquet")`` (the Kafka jar is not
available here), so every parse and state step is the one that runs on Kafka.
"""
