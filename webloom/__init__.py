"""Web-corpus analytics on Spark: crawled pages to a ranked, searchable knowledge base."""
