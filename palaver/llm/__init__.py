"""Operators of a training-data pipeline; nothing else in the library imports them.

Texts travel as UTF-8 bytes in Arrow batches and are worked on in slices of a few
megabytes, so the memory of a task does not depend on how many rows it has.
Intermediate tables are written to the shared folder that ``spark.checkpoint.dir``
names; a lost executor costs the tasks it ran and nothing else.
"""
