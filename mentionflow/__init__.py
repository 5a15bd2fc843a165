"""Technology-mention analytics as Spark DataFrame functions.

Every public function takes and returns DataFrames (or Columns), so plans
compose and stay lazy until the caller writes or collects them.
"""
