"""DataFrame operators: transcript, detection, pairs, rewriting, compression."""
