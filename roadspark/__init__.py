"""Road features from OpenStreetMap-shaped tables, as Spark DataFrames."""
