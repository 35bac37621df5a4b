"""tidemark: daily business reports on Spark DataFrames.

Every public function takes DataFrames (plus plain dates) and returns a lazy
DataFrame.  Nothing reads the clock: the day or the day window is a parameter.
"""
