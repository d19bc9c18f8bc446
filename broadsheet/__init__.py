"""Layout-aware document analytics on Spark."""
