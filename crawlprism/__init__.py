"""Web-corpus analytics as PySpark DataFrame operators.

Sub-packages
------------
sources     archive, metadata and manifest readers; table sinks
functions   column expressions (text, URLs, vectors)
operators   DataFrame -> DataFrame operators
plans       compositions over named tables
streaming   incremental loads on Structured Streaming
registry    named queries with their SQL twins, and the fixtures they run on
"""

__version__ = "0.1.0"
