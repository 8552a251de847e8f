"""End-to-end plans: corpus to gold, export, variants, head labels, merged set."""
