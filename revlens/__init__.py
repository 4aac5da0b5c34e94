"""revlens: review-sentiment analytics expressed as Spark DataFrame jobs.

Every public function takes DataFrames (and plain parameters) and returns a
DataFrame; nothing is collected to the driver except results whose size is
bounded by construction (class counts, a fitted vocabulary, a metric row).
"""

__version__ = "0.1.0"
