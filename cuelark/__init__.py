"""Spark operators for time-stamped transcripts; see README.md."""
