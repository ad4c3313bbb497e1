"""orderflow: Spark-native data-quality and order analytics.

Declarative entity specs drive standardisation, rule validation and the
valid / quarantine split of raw customer, product and order tables; later
operators deduplicate, check referential integrity and build order measures,
metric tables and a small star schema. Everything is a DataFrame plan.
"""

__version__ = "0.1.0"
