"""Document and video metadata tables on Spark.

Everything here maps ``Column -> Column`` (``functions``) or
``DataFrame -> DataFrame`` (``operators``); ``sources`` and ``sinks`` touch
files, and ``plans`` puts the steps together into whole jobs.
"""
