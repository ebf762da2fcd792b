"""bizlens: business-question analytics over Spark DataFrames.

Every job is a function from DataFrames to a DataFrame, built only from the
DataFrame / SQL API so that Catalyst and adaptive execution plan it.
"""

__version__ = "0.1.0"
