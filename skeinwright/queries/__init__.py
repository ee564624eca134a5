"""The queries of the stream-analytics side, each with the SQL that gives the same rows."""
