"""payguard: procure-to-pay event decoding and payment-risk grading on Spark.

Every transform is a ``DataFrame -> DataFrame`` function built from Spark
column expressions, so the same code runs on batch and streaming frames.
IO lives at the edges (``sources`` and ``streaming``); Python runs inside
tasks only for model scoring (``operators.score``).
"""

__version__ = "0.1.0"
