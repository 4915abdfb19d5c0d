"""basketry: retail analytics as composable PySpark DataFrame functions.

Layers: ``sources`` read and write, ``operators`` are reusable relational
building blocks, ``plans`` hold the staging / intermediate / mart models and
the ingest job, ``streaming`` runs the ingest over a landing folder.
"""
