"""Training-data operators: licences, quality, tokens, contamination, secrets, near copies, languages, toxicity."""
