from quarry.streaming.ingest_stream import ingest_stream

__all__ = ["ingest_stream"]
