"""colloquy: conversational training-data preparation and reply evaluation on Spark.

Every operator takes and returns DataFrames (or builds Columns); the heavy lifting
is Catalyst expressions, grouped aggregates, joins and windows. Python only runs
inside Arrow-batched UDFs for the few semantics Catalyst cannot express (strict JSON
parse errors, canonical JSON/YAML equality keys, user-supplied predictors and
tokenizers).
"""

from colloquy.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
