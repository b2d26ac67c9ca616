"""tagloom: multi-label text tagging as Spark jobs.

Subpackages:
  sources    readers / writers (XML dump, partitioned question table, fixture)
  functions  Column expressions (tags, dates, text twins)
  operators  DataFrame operators and ML stages (ETL, labels, features,
             binary relevance, metrics, tuning, scoring)
  plans      end-to-end jobs and the registered query catalogue
  streaming  Structured Streaming scoring
"""

__version__ = "0.1.0"
