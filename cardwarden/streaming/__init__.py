"""The upsert as a stream sink."""
