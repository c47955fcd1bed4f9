"""Training-data operators (quality, decontamination, dedup, sharding, chat, PII, language id,
HTML extraction, packing, near-dedup) and the queries that run them over whole tables."""
