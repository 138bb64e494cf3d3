"""Reading and writing: token text, logs, reports, fingerprints, models."""
