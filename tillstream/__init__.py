"""Real-time retail analytics as PySpark DataFrame functions and streaming jobs."""
