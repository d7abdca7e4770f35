"""Sources: landing folders, topics, serving tables and the lake."""
