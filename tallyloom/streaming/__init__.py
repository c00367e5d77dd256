"""The evaluation as a Structured Streaming job."""
