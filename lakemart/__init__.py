"""A PySpark-native medallion lakehouse and measure engine for retail finance.

``sources``   discovery, copying, layered tables, fixture views
``functions`` column expressions: cleaning rules, blank arithmetic, fingerprints
``operators`` DataFrame to DataFrame steps: history, keys, calendar, star, ranking
``plans``     the layer runner, the star model and the measure catalogue
"""
