"""Table, file, JDBC and stream sources, and the matching sinks."""
