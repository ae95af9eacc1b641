"""Marquee: title-catalogue analytics and live vote ratings on Spark.

Every operation takes DataFrames and returns a DataFrame; nothing collects
rows to the driver and nothing depends on a global session.
"""
