"""Operators for building training corpora: near-duplicate and repeat
removal, quality rules, tokenization, archives, decontamination, chat
formatting and toxicity scoring.  Nothing else in the library imports this
subpackage."""
