"""Options-chain analytics on Spark: quote files in, enriched quotes and trading signals out."""
