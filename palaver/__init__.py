"""palaver: conversation-dataset analytics as plain PySpark DataFrame operators.

The core table is ``messages`` (``conv_id, turn, role, text``), one row per
message.  Every operator maps DataFrames to DataFrames with built-in Spark
expressions; nothing is collected to the driver and no Python UDF is used.
"""

__version__ = "0.1.0"
