"""Structured Streaming jobs and sinks. Window logic is shared with batch in operators.windows."""
