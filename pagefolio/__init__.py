"""Company profiles from crawled web pages, as Spark jobs."""
