"""goldleaf: layered (bronze -> silver -> gold) performance analytics as plain
PySpark DataFrame functions.

Every public function takes and returns DataFrames and uses built-in Spark
expressions only, so the same code runs on batch and Structured Streaming
inputs and stays inside whole-stage codegen.
"""

__version__ = "0.1.0"
