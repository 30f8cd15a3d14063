"""Tabular profiling, verbalisation and training-set assembly on Spark.

Every public function takes and returns DataFrames (or Column expressions);
see the README for the map of modules.
"""

from tabulore.operators.profile import Profile, ProfileOptions
from tabulore.session import build_session
from tabulore.sources.tables import TableSet

__all__ = ["Profile", "ProfileOptions", "TableSet", "build_session"]
