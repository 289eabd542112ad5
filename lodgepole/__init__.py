"""lodgepole: a Spark-native analytics engine for short-stay rental data.

Layers (each a plain DataFrame transformation, sinks only at the edge):

* ``sources``   – readers (Parquet, CSV, JDBC, catalog), NaN normalisation,
                  and the mapping of the driver's TPC-H-style tables onto the
                  rental domain (listings, attributes, bookings, views).
* ``functions`` – column helpers (date parsing, ISO weeks, month spine,
                  exact money, Spark-compatible rounding).
* ``operators`` – cleaning, curation, business metrics, profiling, upserts.
* ``plans``     – sinks, layer tables, layout, load + reconciliation and the
                  end-to-end batch job.
* ``llm``       – operators for training corpora; nothing else imports it.
"""

from lodgepole.session import get_session, lake_root

__all__ = ["get_session", "lake_root"]
