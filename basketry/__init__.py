"""basketry — a Spark-native retail star-schema warehouse and KPI engine.

Sources are staged with declared schemas, products are classified into an
analysis scope by rule tables, data-quality rules are evaluated in fused
aggregate passes, dimensions / bridges / facts are built with stable keys and
an insert-only merge, every table is reconciled against its source, and KPIs
are plain DataFrame queries.  All heavy work is DataFrame / SQL on Spark.
"""

__version__ = "0.1.0"
