"""Area scoring on Spark: clean events, place them in areas, score and compare the areas."""

__version__ = "0.1.0"
