"""Structured Streaming ingest."""
from .ingest import (bronze_batch_writer, checkpoint_path, hourly_volume_stream,  # noqa: F401
                     kafka_source, start_bronze_stream, stream_source)
