"""Operators on text collections and embeddings, their queries and the SQL that checks them."""
