"""formline: recent-form analytics for game-like data, written as Spark DataFrame jobs."""
