from textloom.streaming.ingest import stream_distinct_urls, stream_filter, stream_split
