"""Training-data operators over document tables (encoding, de-duplication, scoring, packing)."""
