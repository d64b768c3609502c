"""Milepost: construction-milestone forecasting and review rules on Spark DataFrames."""
