"""Property listings and sales as Spark DataFrames.

Every public function takes DataFrames (and plain parameters) and returns
DataFrames; nothing holds a session and nothing calls ``now()``.
"""
