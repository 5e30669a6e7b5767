"""Find and mask personal data in conversation tables, logs and streams."""
