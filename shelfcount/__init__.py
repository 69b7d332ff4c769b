"""Print-holdings overlap and cost engine on Spark.

Every public function takes DataFrames (and plain parameters) and returns
DataFrames, so that Catalyst sees one declarative plan per report.
"""

__version__ = "0.1.0"
