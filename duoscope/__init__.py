"""duoscope: compare ratings of the same items across two catalogues, as Spark jobs.

Every operator takes and returns DataFrames; column names are parameters.
"""

__version__ = "0.1.0"
