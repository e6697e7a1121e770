"""larder: retail and food-and-beverage analytics as plain Spark DataFrame jobs.

Every operator takes DataFrames and returns a DataFrame; nothing here collects
rows to the driver. See README.md for the map of modules.
"""
