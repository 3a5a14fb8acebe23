"""Turn published statistics into analysis-ready tables, as Spark DataFrames.

Every public function takes and returns DataFrames or Columns and stays lazy;
nothing here collects data rows to the driver.
"""
