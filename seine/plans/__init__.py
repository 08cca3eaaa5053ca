"""Multi-step jobs: crawling the captured link graph, summaries and reports."""
