"""Sources: captures, robots documents, sitemaps and seeds."""
