"""urbanlake — city mobility and public-health analytics as Spark DataFrame plans.

Layout:

* ``sources``   — typed CSV landing, WKT geometry parsing, test-table adapters
* ``functions`` — column expressions (calendar, geometry, labels, severity)
* ``operators`` — reusable relational operators (spatial join, dense spine,
  endpoint totals, quartiles, top-k, trailing windows)
* ``plans``     — staging, the eight reports and the end-to-end pipeline
* ``sinks``     — table / CSV / JSON / JDBC writers with create-if-absent,
  append and overwrite modes
* ``streaming`` — incremental staging of newly landed trip files
"""

__version__ = "0.1.0"
