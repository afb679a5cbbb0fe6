"""meteoframe: environmental feed analytics as Spark DataFrame jobs.

Entry points, from the outside in:

* ``meteoframe.tasks``      one function per scheduled job: landed feed files
                            in, tables out (batch and streaming forms).
* ``meteoframe.plans``      the per-feed transformations (dust, quake,
                            typhoon, forecast, score) as DataFrame -> DataFrame.
* ``meteoframe.sources``    readers for the landed feeds (text in any charset,
                            fixed width, XML, JSON, CSV) and writers back.
* ``meteoframe.sinks``      table writes: append, overwrite, MERGE, day
                            replacement, retention, exports.
* ``meteoframe.operators``  reusable operators (dedupe, checked joins, pivot,
                            ranking, merge algebra, grids, quality checks).
* ``meteoframe.functions``  Column -> Column expressions (parsing, sentinels,
                            grades, indices, dates).
* ``meteoframe.streaming``  Structured Streaming helpers.

``meteoframe.session.configure(spark)`` applies the runtime settings the jobs
rely on to an existing session.
"""

__version__ = "0.1.0"
