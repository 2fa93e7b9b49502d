"""Feed shaping and the compaction job."""
