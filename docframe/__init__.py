"""docframe: document structuring over Spark DataFrames.

Pages, Markdown, layout blocks, table cells and model responses are plain
DataFrames; every operator is a function from DataFrames to a DataFrame.
"""

__version__ = "0.1.0"
