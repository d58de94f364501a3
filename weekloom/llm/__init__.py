"""Operators for preparing training text: archives, near-duplicates, quality,
decontamination, line dedup, secrets, language models, token counts, mixing."""
