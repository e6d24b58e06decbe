"""orelode: data-mining operators on Spark DataFrames.

``functions``  column expressions (distances, keyed uniforms, text parsing)
``sources``    line readers and parsers, result writers, saved models
``operators``  statistics, K-Means with patterns, Naive Bayes, PCA, TF-IDF, ALS
``plans``      the end-to-end jobs and the queries checked against SQL
"""
