"""Complete jobs composed of the operators: masking, sinks and metrics."""
