"""Activity lake: employee-activity data pipelines as Spark DataFrame functions.

Every operator takes and returns DataFrames (or Columns), so the same code
serves batch jobs and Structured Streaming jobs.
"""
