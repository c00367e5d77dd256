"""Rule-driven windowed metrics as Spark DataFrame plans."""
