"""newsmart: news- and filing-stream analytics as plain Spark jobs.

Every operator is a function from DataFrame to DataFrame.  The same functions
serve batch jobs and Structured Streaming; see ``plans`` for the pipelines they
compose into and ``streaming`` for how a stream is wired to its sinks.
"""

__version__ = "0.1.0"
