"""tallyspark: a Spark-native ledger ETL and categorisation engine.

Bank statement exports are read as text, cleaned, parsed into fields,
categorised by exact / substring / fuzzy matching against a taxonomy, keyed
by a deterministic hash, loaded incrementally into month partitions and
consolidated into a de-duplicated master table.  Every stage is a
DataFrame -> DataFrame function built from Spark SQL expressions.
"""

__version__ = "0.1.0"
