"""Readers: message envelopes, session logs, operator prompts, model responses."""
