"""patronage: constituent-profile extracts for fundraising data, built on Spark.

Every public function maps (Tables, Params) to a lazy DataFrame; nothing is
collected except the single fiscal-year parameter (see ``params.py``).
"""

from patronage.params import Params
from patronage.tables import Tables

__all__ = ["Params", "Tables"]
