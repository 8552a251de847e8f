"""Sources: raw text with line provenance, bronze tables, lexicon files."""
