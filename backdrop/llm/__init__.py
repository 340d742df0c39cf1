"""Training-data operators: sharding, tokenising, decontamination, language
identification, near and exact duplicates, language-model scoring, toxicity
and personal data. Nothing outside this subpackage imports it."""
