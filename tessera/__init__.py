"""tessera: a catalogue of DataFrame jobs (text, log shares, matching, time series).

Every job takes DataFrames plus parameters and returns a lazy DataFrame built
from built-in Spark SQL expressions; the caller decides when to act on it.
"""

from tessera.session import build_session, scratch_root

__all__ = ["build_session", "scratch_root"]
