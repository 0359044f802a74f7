"""Training-data operators: near duplicates, filters, redaction, language-model
scores, packing. Nothing else in the library imports this subpackage."""
