"""The warehouse's streaming jobs."""
