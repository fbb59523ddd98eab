"""postlake — Spark-native analytics for web-collected job postings.

Sub-packages:
    functions  column expressions (text, urls, keys, html, arrays, classifiers)
    rules      fixed rule tables (keywords, coordinates, stopwords, selectors)
    operators  DataFrame-level operators (frequencies, profiles, dedup, lookups,
               HTML extraction job)
    sources    scans and sinks (recursive Parquet scan, layered sinks, pages,
               crawl frontier)
    plans      end-to-end jobs (posting pipeline, notebook analyses, driver
               queries)
    streaming  incremental per-day runner on Structured Streaming
"""

__all__ = ["functions", "operators", "sources", "plans", "rules", "streaming"]
