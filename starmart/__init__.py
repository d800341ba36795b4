"""starmart: a PySpark-native order / bonus / delivery warehouse.

Layers: staging (``sources``), detail data store jobs and marts (``plans``),
reusable DataFrame operators (``operators``), column functions
(``functions``) and Structured Streaming forms of the loads (``streaming``).
"""

__version__ = "0.1.0"
