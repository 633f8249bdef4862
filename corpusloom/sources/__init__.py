"""Sources and sinks of token shards, text corpora and JSON lines."""
