"""Row quality, summaries, statistics, chart tables and the slow-trip model."""
