"""quotemill: company rankings and daily stock quotes as a layered Spark warehouse."""
