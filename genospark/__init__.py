"""genospark: SNP genotype upload processing as Spark DataFrame jobs.

Sub-packages:
  sources    readers for the upload queue, catalogue tables and zipped text files
  functions  column expressions shared by the operators (line trimming, literal split, decode)
  operators  DataFrame-in / DataFrame-out operators (parsing, maps, reports, encoding,
             reconciliation, outcomes, population-genetics extensions)
  plans      the batch pipeline that chains the operators, fixtures and sinks
  streaming  Structured Streaming driver for the upload queue
"""

__version__ = "0.1.0"
