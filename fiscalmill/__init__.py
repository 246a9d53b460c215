"""fiscalmill: a Spark medallion library for messy yearly public-finance files.

The package is a set of plain DataFrame -> DataFrame functions:

* ``functions``  Column expressions (keys, safe arithmetic, text cleaning, URLs)
* ``operators``  table operators (dedup, union, pivot, series, ids, neighbours)
* ``quality``    data-quality checks that return failing rows, and the layer gate
* ``sources``    readers, header unification, manifests, layer tables
* ``plans``      the fiscal-risk models, reports, dashboard cards and insights
"""
