"""ridgeline: hourly weather suitability for places, built on Spark DataFrames.

Landed forecast documents and place records go in; typed hourly rows, a place
hierarchy, a spatial place-to-cell match, the newest forecast per place and
hour, an hourly condition score and the read queries on top come out. Every
operator is a function from DataFrames/Columns to a DataFrame/Column, so
Catalyst sees one declarative plan.
"""

__version__ = "0.1.0"
