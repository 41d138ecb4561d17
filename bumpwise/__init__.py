"""Road-impact analytics on Spark: trips in, repair priorities out."""
