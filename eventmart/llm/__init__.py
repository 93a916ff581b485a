"""Operators for preparing training data: text, pages and embeddings, at corpus scale."""
