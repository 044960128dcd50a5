"""Event analytics on Spark: windows, rankings, joins, patterns and keyed state.

Every operator is a function from DataFrame to DataFrame.  The layers are

* ``plans``      plan shapes shared by the operators (ordered scans, panes, skew)
* ``operators``  the analytics themselves
* ``functions``  scalar expressions and user functions
* ``sources`` / ``sinks``  reading and writing
* ``streaming``  Structured Streaming twins and the replay harness
* ``jobs``       the registered queries with their SQL oracles
"""
