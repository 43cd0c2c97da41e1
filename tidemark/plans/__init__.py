"""tidemark.plans."""
