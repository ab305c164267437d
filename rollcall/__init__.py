"""rollcall: user analytics on Spark, from raw profiles to dated percentage distributions.

``sources`` and ``streaming`` bring data in and out, ``operators`` are pure DataFrame
transformations built from the expressions in ``functions``, ``plans`` are the jobs.
"""
