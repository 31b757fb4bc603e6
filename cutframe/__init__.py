"""Timeline analytics over many clips, reels and jobs at once, as Spark DataFrame jobs."""
