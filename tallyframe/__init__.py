"""tallyframe: evidence analytics as pure DataFrame functions on PySpark."""
