"""Raw objects, snapshot decoding and the curated tables."""
