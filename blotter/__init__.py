"""blotter: incident analytics expressed as Spark DataFrame plans.

Every operator is a ``DataFrame -> DataFrame`` function built from
``pyspark.sql.functions`` so Catalyst can prune, push down and partially
aggregate it. Sub-packages:

* ``sources``   -- readers: delimited files, text lines, the driver-table view
* ``functions`` -- column expressions (code normalisation, arrest flags, ...)
* ``operators`` -- cleaning, counting, joins, rates, ordering and layout
* ``plans``     -- the end-to-end jobs and the registered query catalogue
* ``streaming`` -- the same transforms applied to a file stream
* ``sinks``     -- delimited and text writers
"""

