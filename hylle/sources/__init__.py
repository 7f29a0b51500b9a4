"""Table and page sources and sinks."""
