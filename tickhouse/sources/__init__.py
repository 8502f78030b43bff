"""Readers and writers: message streams, candle and article files, lake tables, JDBC, exports."""
